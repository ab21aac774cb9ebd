"""Numbers, neighbours and sums by ranges equal those of one window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptorium.operators import ranges, sections


@pytest.mark.parametrize("size, parts", [(10, 4), (100_000, 256)])
def test_equal_to_windows(spark, size, parts):
    rng = random.Random(size)
    rows = [("hot", rng.choice([i, i, 10**9 + i]), rng.randint(-3, 9), rng.choice(["x", None, f"v{i}"])) for i in range(400)] + [(k, i, i, f"{k}{i}") for k in ("a", None) for i in range(7)] + [("one", 5, 1, "o")]
    rows = list({(k, o): (k, o, v, s) for k, o, v, s in rows}.values())
    df = spark.createDataFrame(rows, "key string, o bigint, v int, s string").repartition(3)
    w = Window.partitionBy("key").orderBy("o")
    want = df.withColumns({"n": F.row_number().over(w), "t": F.sum("v").over(w), "previous": F.lag("s").over(w), "next": F.lead("s").over(w)})
    got = ranges.neighbours(ranges.running_sum(ranges.numbered(df, "key", "o", "n", size, parts), "key", "o", F.col("v"), "t", size, parts), "key", "o", "s", size, parts)
    assert got.columns == ["key", "o", "v", "s", "n", "t", "previous", "next"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))
    if size == 10:
        held = ranges.dealt(df, "key", "o", size, parts).groupBy("key", "_range").count().where("key = 'hot'")
        assert held.count() >= 3 and held.agg(F.max("count")).first()[0] < 250


def test_equal_orders_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, 1)] * 30 + [("a", 2, 5)] * 3, "key string, o int, v int")
    got = {(r.o, r.t) for r in ranges.running_sum(df, "key", "o", F.col("v"), "t", 5, 4).collect()}
    assert got == {(1, 30), (2, 45)}
    assert sorted(r.n for r in ranges.numbered(df, "key", "o", "n", 5, 4).collect()) == list(range(1, 34))
    assert ranges.numbered(df.limit(0), "key", "o", "n").count() == 0


def test_parent_pages(spark):
    rows = [(1, True, "heading_only", 3), (2, False, "none", 4), (3, False, "context", 5), (4, False, "context", 9), (5, True, "heading_only", 3), (6, False, "context", 30), (7, True, "context", 8), (8, True, "heading_only", 8)]
    df = spark.createDataFrame([(k, *r) for k in ("w", None) for r in rows], "work string, pos int, is_parent boolean, status string, page int")
    got = sorted((r.pos, r.page) for r in sections.repair_parent_pages(df, "work", "pos").where("work IS NULL").collect())
    assert got == [(1, 5), (2, 4), (3, 5), (4, 9), (5, 3), (6, 30), (7, 8), (8, 8)]
