import numpy as np
import pytest

from claimweave.llm import embeddings
from claimweave.llm.blocks import roots

SCHEMA = "vec_id bigint, embedding array<{kind}>, label int, id bigint, key string"


def vectors(seed=0, n=300, dims=24):
    """Clusters around random directions, pairs close to the limit, and copies."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x)
    out = []
    for k in range(n):
        base = unit(rng.normal(size=dims))
        out.append(base * rng.uniform(0.1, 9))
        for cos in rng.uniform(0.9, 1.0, int(rng.integers(0, 4))):
            other = rng.normal(size=dims)
            other = unit(other - other @ base * base)
            out.append(cos * base + np.sqrt(1 - cos * cos) * other)
    return [[float(np.float32(x)) for x in v] for v in out]


def brute(rows):
    """n_links and component by comparing everything."""
    ok = [v is not None and len(v) > 0 and label is not None and i is not None and
          all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v, label, *_ in rows]
    first = {}
    for k, r in enumerate(rows):
        if ok[k]:
            first.setdefault((r[0], tuple(r[1]), r[2]), k)
    own = list(first.values())
    links = {k: set() for k in own}
    for a in own:
        for b in own:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[a].add(b)
                    links[b].add(a)
    pairs = [(a, b) for a in own for b in links[a]]
    root = roots(len(rows), np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int))
    low = {}
    for k in own:
        low[root[k]] = min(low.get(root[k], rows[k][0]), rows[k][0])
    out = []
    for k, r in enumerate(rows):
        at = first.get((r[0], tuple(r[1]), r[2])) if ok[k] else None
        out.append((r[0], len(links[at]), low[root[at]]) if at is not None else (r[0], 0, r[0]))
    return out


def found(spark, rows, kind="float", **kw):
    df = spark.createDataFrame(rows, SCHEMA.format(kind=kind))
    return [tuple(r) for r in embeddings.near_duplicates(df, **kw).select("vec_id", "n_links", "component_id").collect()]


@pytest.mark.parametrize("block_rows", [5, 1024])
def test_recall_and_precision(spark, block_rows):
    rows = [(k, v, k % 3 % 2, 0, "x") for k, v in enumerate(vectors())]
    rows += [(5000 + k, rows[0][1], 0, 0, "x") for k in range(40)]
    want = {i: n for i, n, _ in brute(rows)}
    got = {i: n for i, n, _ in found(spark, rows, block_rows=block_rows)}
    assert set(got) == set(want)
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.99 * sum(want.values()) > 0


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1),
            (11, [1.0, 0.0], 2), (None, [1.0, 0.0], 1), (12, [-1.0, 0.0], 1), (13, [-0.0, 1e-30], 1), (14, [0.0, 1e30], 1)]
    rows = [(*r, 0, "x") for r in rows]
    for kind in ("float", "double"):
        assert sorted(found(spark, rows, kind), key=str) == sorted(brute(rows), key=str)
    assert found(spark, []) == []


def test_hadamard_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    y = embeddings._hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(embeddings._hadamard(y), x)


def test_query_against_brute_force(spark):
    from claimweave.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in QUERIES["op5_embedding_near_dedup"](spark, sf).collect())
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = sorted((i, n, c, i == c) for i, n, c in brute(rows))
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.9 * len(want)
