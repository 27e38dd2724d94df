"""DataFrame operators. Most are lazy; ``not_in``, ``classify_by_priority``, ``rank_desc_split``,
``semi_in_filtered`` and ``salted_join`` run a job of their own while they build (a written table or a sketch)."""

from claimweave.operators.nested import explode_rows, explode_path, keep_elements
from claimweave.operators.snapshots import current_month, latest_snapshot, snapshot
from claimweave.operators.joins import (classify_by_priority, flag_from_keys, join_hit,
                                        lookup_code, not_in, semi_in)
from claimweave.operators.aggs import (aligned_lists, count_distinct_by, first_pair, list_of_pairs,
                                       ordered_list, repeat_flag)
from claimweave.operators.chunks import list_chunks
from claimweave.operators.filtered import semi_in_filtered
from claimweave.operators.heavy import heavy_keys, salted_join
from claimweave.operators.sketches import error_bound, merged_distinct, monthly_sketches
from claimweave.operators.states import event_state, merge_states, repeated
from claimweave.operators.windows import latest_per_key, latest_value_per_key, rank_desc, rank_desc_split
from claimweave.operators.sets import both_feeds, union_all
from claimweave.operators.rows import mask, require_not_null

__all__ = [
    "explode_rows", "explode_path", "keep_elements",
    "current_month", "latest_snapshot", "snapshot",
    "classify_by_priority", "flag_from_keys", "join_hit", "lookup_code", "not_in", "semi_in",
    "aligned_lists", "count_distinct_by", "first_pair", "list_of_pairs", "ordered_list", "repeat_flag",
    "list_chunks", "error_bound", "merged_distinct", "monthly_sketches", "event_state", "merge_states", "repeated",
    "semi_in_filtered", "heavy_keys", "salted_join",
    "latest_per_key", "latest_value_per_key", "rank_desc", "rank_desc_split",
    "both_feeds", "union_all",
    "mask", "require_not_null",
]
