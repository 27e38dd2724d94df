import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward, doc, frame, prose

from claimweave.llm import simhash
from claimweave.llm.blocks import roots


def brute_fingerprint(text: str | None, k: int = 3) -> int:
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits=3):
    a, b = np.nonzero([[bin(x ^ y).count("1") <= bits for y in fps] for x in fps])
    root = roots(len(fps), a, b)
    return [min((i for i, r in zip(ids, root) if r == own and i is not None), default=None) for own in root]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \n\t\vçÉ.", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_fingerprint_of_long_text_in_slices():
    text = " ".join(str(i % 977) for i in range(400_000))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_awkward_rows(spark):
    rows = awkward()
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], [np.uint64(x).astype(np.int64).item() for x in fps],
                      brute_components([r[0] for r in rows], fps)), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_hot_bucket_in_blocks_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    base = int(rng.integers(0, 1 << 62))
    fps = sorted({base ^ sum(1 << int(b) for b in rng.choice(32, k, replace=False)) for k in (0, 1, 2, 4, 7) for _ in range(60)})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    index, probe = simhash.buckets(nodes, 3, 2)
    for block_rows in (8, 4096):
        links = simhash.compare(simhash.deal(index, probe, block_rows), simhash._forest(3), "a long, b long")
        got = {r["node"]: r["component"] for r in simhash.components(links).collect()}
        want = brute_components(fps, fps)
        assert [got.get(f, f) for f in fps] == want


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_segments_find_all_distances(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 40, dtype=np.int64)
    fps = {int(x) for x in base} | {int(np.int64(np.uint64(x) ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, d, replace=False)))))
                                     for x in base for d in (1, 2, 3, 4)}
    ids = sorted(fps)
    nodes = spark.createDataFrame([(f,) for f in ids], "fp bigint")
    want = brute_components(ids, [f & (1 << 64) - 1 for f in ids])
    for segments in (2, 4):
        index, probe = simhash.buckets(nodes, 3, segments)
        links = simhash.compare(simhash.deal(index, probe, 64), simhash._forest(3), "a long, b long")
        got = {r["node"]: r["component"] for r in simhash.components(links).collect()}
        assert [got.get(f, f) for f in ids] == want, segments


def test_near_copies_join(spark):
    long = " ".join(prose(k) for k in range(40))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(
        frame(spark, [doc(4, long), doc(2, long.upper()), doc(3, prose(100))])).collect()}
    assert got == {4: 2, 2: 2, 3: 3}
