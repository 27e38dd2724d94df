import numpy as np
import pytest

from claimweave.llm.blocks import roots
from claimweave.llm.components import components


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = np.random.default_rng(3)
    links = {"path": [(i, i + 1) for i in range(40)], "star": [(99, i) for i in range(50)],
             "random": [tuple(map(int, rng.integers(0, 80, 2))) for _ in range(60)], "none": [(5, 5)]}[kind]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    root = roots(100, np.array([a for a, _ in links]), np.array([b for _, b in links]))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: int(root[x]) for x in linked}
