"""Embedding near-dedup against all pairs: dense groups, tiles, odd vectors, repeated rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.llm import embedding_join
from zonepulse.llm.embedding_join import COSINE, link_near


def plain_links(data, cosine=COSINE):
    """(n_links, component, kept) of each (key, vector, label), by all pairs in double precision."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        v = v / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units = [unit(v) if label is not None else None for _, v, label in data]
    n = len(data)
    links = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and data[i][2] == data[j][2]
              and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine] for i in range(n)]
    component = list(range(n))
    for i in range(n):
        seen, queue = {i}, [i]
        while queue:
            for j in links[queue.pop()]:
                if j not in seen:
                    seen.add(j)
                    queue.append(j)
        component[i] = min((data[j][0] for j in seen if data[j][0] is not None), default=None)
    return sorted(((data[i][0], len(links[i]), component[i], data[i][0] == component[i]) for i in range(n)), key=repr)


def frame(spark, data, kind="float"):
    return spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>, label int").withColumns(
        {c: F.lit("mine") for c in ("key", "vector", "node", "cell", "n", "a", "_part")})


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def clouds(rng, dims, sizes, spread):
    """Around one centre for each size, vectors at all distances from it: pairs well above, near and below the limit."""
    out = []
    for size in sizes:
        centre = rng.standard_normal(dims)
        for _ in range(size):
            out.append(centre + rng.uniform(0, spread) * rng.standard_normal(dims))
    return np.array(out, np.float32)


@pytest.mark.parametrize("dims", [2, 3, 12, 64, 100])
def test_equals_all_pairs(spark, dims):
    rng = np.random.default_rng(dims)
    vectors = clouds(rng, dims, [60, 30, 1, 1], 0.3)
    data = [(int(i * 7 % 1000), v.tolist(), int(i % 2)) for i, v in enumerate(vectors)]
    expected = plain_links(data)
    assert 0 < sum(r[1] for r in expected) < len(data) ** 2 / 2
    assert got(link_near(frame(spark, data))) == expected


@pytest.mark.parametrize("cell,tile", [(4, 16), (1 << 20, 16), (1, 1 << 20)])
def test_any_cells_and_tiles(spark, monkeypatch, cell, tile):
    """All coordinates cut or one, large cells in tiles or not: the same links."""
    monkeypatch.setattr(embedding_join, "CELL", cell)
    monkeypatch.setattr(embedding_join, "TILE", tile)
    vectors = clouds(np.random.default_rng(7), 16, [120, 80], 0.25)
    data = [(i, v.tolist(), 3) for i, v in enumerate(vectors)]
    assert got(link_near(frame(spark, data))) == plain_links(data)


def test_cosines_about_the_limit(spark):
    """Pairs whose cosines are within half precision of the limit are told apart."""
    data = []
    for k in range(40):
        angle = math.acos(COSINE) + (k - 19.5) * 1e-6
        base = [0.0] * 10
        base[k % 5] = 1.0
        other = [0.0] * 10
        other[k % 5], other[5 + k % 5] = math.cos(angle), math.sin(angle)
        data += [(2 * k, base, k), (2 * k + 1, other, k)]
    result = got(link_near(frame(spark, data, "double")))
    assert result == plain_links(data)
    assert sum(r[1] for r in result) == 40


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 1.0], None),
            (8, [1.0, 1.0], 1), (9, [2.0, 2.0], 1), (9, [2.0, 2.0], 1), (9, [-1.0, 5.0], 1), (10, [1.0, 1.0, 1.0], 1), (11, [1.0], 1),
            (12, [3.0], 1), (None, [1.0, 1.0], 1), (None, [-7.0, -7.0], 1), (13, [1e300, 1e300], 2), (14, [1e-300, 1e-300], 2),
            (15, [-0.0, 1.0], 4), (16, [0.0, 1.0], 4), (1, None, 1)]
    assert got(link_near(frame(spark, data, "double"))) == plain_links(data)
    assert link_near(frame(spark, [])).count() == 0


def test_copies_are_one_class(spark):
    data = [(i, [1.0, 2.0, 3.0], 1) for i in range(500)] + [(1000, [1.0, 2.0, 3.1], 1), (1001, [-1.0, 2.0, 3.0], 1)]
    assert got(link_near(frame(spark, data))) == plain_links(data)


def test_blocks_share_the_budget():
    for dims in (1, 7, 8, 9, 64, 100):
        edges = embedding_join.blocks(dims)
        assert [b - a for a, b in edges] and max(b - a for a, b in edges) <= embedding_join.BLOCK_DIMS and edges[-1][1] == dims
        assert math.isclose(sum(embedding_join.radii(dims, 0.98) ** 2), (0.2 + 2 * embedding_join.ROUNDED) ** 2, rel_tol=1e-4)
