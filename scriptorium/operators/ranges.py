"""Numbers, neighbours and running sums in the order of a key's rows, by ranges of that order: no task has all rows of a long key.

A key with more than SIZE rows is cut at quantiles of its order into RANGES ranges; each range is a window of its own, and what goes
from range to range (counts, sums, first and last values) is a row a range. Orders are numbers; equal ones are in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 100_000
RANGES = 256


def dealt(rows: DataFrame, key: str, order: str, size: int = SIZE, ranges: int = RANGES) -> DataFrame:
    """rows with _k (the key, null as a value like others) and _range."""
    rows = rows.withColumn("_k", F.struct(F.col(key).alias("key")))
    parts = [F.lit(i / ranges) for i in range(1, ranges)]
    long = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(order, F.array(*parts), F.lit(10 * ranges)).alias("_bounds")).where(F.col("_n") > size)
    rows = rows.join(long.select("_k", "_bounds"), "_k", "left")
    return rows.withColumn("_range", F.coalesce(F.size(F.filter("_bounds", lambda b: b < F.col(order))), F.lit(0))).drop("_bounds")


def _carried(rows: DataFrame, per_range: dict[str, Column], carry) -> DataFrame:
    """rows with what carry makes of the rows that per_range gives for each range, in the order of ranges."""
    edges = rows.groupBy("_k", "_range").agg(*[c.alias(name) for name, c in per_range.items()])
    w = Window.partitionBy("_k").orderBy("_range")
    found = edges.select("_k", "_range", *[c.alias(name) for name, c in carry(w).items()])
    return rows.join(found, ["_k", "_range"])


def numbered(rows: DataFrame, key: str, order: str, name: str, size: int = SIZE, ranges: int = RANGES) -> DataFrame:
    """rows with name: their number, from 1, in the order of their key."""
    before = lambda w: {"_before": F.coalesce(F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}
    rows = _carried(dealt(rows, key, order, size, ranges), {"_rows": F.count(F.lit(1))}, before)
    place = F.row_number().over(Window.partitionBy("_k", "_range").orderBy(order))
    return rows.withColumn(name, (F.col("_before") + place).cast("int")).drop("_k", "_range", "_before")


def running_sum(rows: DataFrame, key: str, order: str, value: Column, name: str, size: int = SIZE, ranges: int = RANGES) -> DataFrame:
    """rows with name: the sum of value up to them, rows of an equal order included."""
    before = lambda w: {"_before": F.coalesce(F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}
    rows = _carried(dealt(rows.withColumn("_value", value), key, order, size, ranges), {"_sum": F.sum("_value")}, before)
    upto = F.coalesce(F.sum("_value").over(Window.partitionBy("_k", "_range").orderBy(order)), F.lit(0))
    return rows.withColumn(name, F.col("_before") + upto).drop("_k", "_range", "_before", "_value")


def neighbours(rows: DataFrame, key: str, order: str, value: str, size: int = SIZE, ranges: int = RANGES) -> DataFrame:
    """rows with previous and next: value of the rows before and behind them in the order of their key."""
    ends = {"_first": F.min_by(F.struct(value), order), "_last": F.max_by(F.struct(value), order)}
    rows = _carried(dealt(rows, key, order, size, ranges), ends, lambda w: {"_before": F.lag("_last").over(w), "_behind": F.lead("_first").over(w)})
    w = Window.partitionBy("_k", "_range").orderBy(order)
    previous, following = F.coalesce(F.lag(F.struct(value)).over(w), F.col("_before")), F.coalesce(F.lead(F.struct(value)).over(w), F.col("_behind"))
    rows = rows.withColumns({"_before": previous, "_behind": following})
    return rows.withColumns({"previous": F.col(f"_before.{value}"), "next": F.col(f"_behind.{value}")}).drop("_k", "_range", "_before", "_behind")
