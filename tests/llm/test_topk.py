import math

import numpy as np
import pytest

from scriptorium.llm import topk


def brute(rows, every, k):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in {i: q for i, q in sound if i % every == 0}.items():
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in sound if j != i and len(v) == len(q))
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])}
    return out


@pytest.mark.parametrize("tile,block", [(32, 4), (10_000, 256)])
def test_against_brute_force(spark, tile, block):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(700)]
    rows += [(i, rows[i % 7][1]) for i in range(700, 760)]  # ties
    rows += [(800, None), (801, []), (802, [1.0] * 7 + [None]), (803, [float("nan")] * 8), (804, [float("-inf")] * 8), (None, [1.0] * 8), (805, [0.0] * 8), (900, [2.0, 3.0]), (901, [1.0, 1.0]), (5, rows[5][1])]
    df = spark.createDataFrame([(v, i, 1) for i, v in rows], "embedding array<float>, vec_id bigint, score int").repartition(3)
    q = topk.quantised(df)
    got = topk.search(q, q.where("vec_id % 5 = 0"), 5, tile, block).collect()
    assert {tuple(r) for r in got} == brute(rows, 5, 5) and len(got) == len(brute(rows, 5, 5))
    assert topk.search(q.limit(0), q.limit(0)).count() == 0


def test_bounds_cut_off_most_rows():
    rng = np.random.default_rng(4)
    v = np.floor(256 * rng.normal(size=(4000, 6)) ** 3).astype(np.int64)
    t = topk.Tile(np.arange(4000), v)
    for i in range(50):
        ids, scores = t.best(i, v[i], 5)
        every = v @ v[i]
        every[i] = -(2**40)
        assert list(ids) == list(np.lexsort((np.arange(4000), -every))[:5]) and list(scores) == list(every[ids])


def test_reading_ends_when_few_can_qualify():
    rng = np.random.default_rng(6)
    v = np.floor(256 * rng.normal(size=(4000, 6)) ** 3).astype(np.int64)
    t = topk.Tile(np.arange(4000), v)
    found = t.best_of(np.arange(40), v[:40], 5)
    assert all(len(ids) == 5 for ids, _ in found) and len(t.read) == 40
    assert t.resolved <= 40 * topk.FINAL * 5  # never a large part of the tile
    assert min(t.read) < 1  # and some before the lists' ends


def test_large_whole_numbers_are_exact():
    big = 2**30 + 1
    t = topk.Tile(np.arange(3), np.array([[big, 0], [big - 1, 1], [-big, 5]]))
    ids, scores = t.best(9, np.array([big, 1]), 2)
    assert list(ids) == [0, 1] and list(scores) == [big * big, (big - 1) * big + 1]
    wide = topk.Tile(np.arange(2), np.array([[2**40, 2**40 - 1], [2**40, -(2**40)]]))
    ids, scores = wide.best(9, np.array([2**22, 2**22]), 2)
    assert list(ids) == [0, 1] and list(scores) == [2**63 - 2**22, 0]
    with pytest.raises(OverflowError):
        wide.best(9, np.array([2**40, 2**40]), 1)


def test_repeated_ids_ask_with_the_least_vector(spark):
    rows = [(0, [1.0, 0.0]), (0, [-1.0, 0.0]), (1, [2.0, 0.0]), (2, [-2.0, 0.0]), (0, [1.0, 0.0])]
    for part in (1, 3):
        df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id bigint, embedding array<float>").repartition(part)
        q = topk.quantised(df)
        got = sorted((r.query_id, r["rank"], r.vec_id) for r in topk.search(q, q.where("vec_id = 0"), 5).collect())
        assert got == [(0, 1, 2), (0, 2, 1)]
