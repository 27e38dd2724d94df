"""Column helpers. Each returns a built-in Spark ``Column`` (no UDFs)."""

from claimweave.functions.keys import (claim_key, pad_lot, prefixed, strip_prefix,
                                       truncate_key)
from claimweave.functions.text import (digits_only, digits_or_raw, first_token,
                                       normalise_place, recode, remove_char, trim_ws)
from claimweave.functions.dates import (add_stay, days_between, earlier_of, fmt_datetime,
                                        fmt_yyyymm, in_year, month_end_fallback,
                                        month_start, safe_date, strict_date, ts_ntz)
from claimweave.functions.money import pick_amount, picked, to_double

__all__ = [
    "claim_key", "pad_lot", "prefixed", "strip_prefix", "truncate_key",
    "digits_only", "digits_or_raw", "first_token", "normalise_place", "recode",
    "remove_char", "trim_ws",
    "add_stay", "days_between", "earlier_of", "fmt_datetime", "fmt_yyyymm", "in_year",
    "month_end_fallback", "month_start", "safe_date", "strict_date", "ts_ntz",
    "pick_amount", "picked", "to_double",
]
