"""Mixing sources to target weights by entropy balancing.

Every document gets a rate r; the rates minimise the token-weighted entropy sum(size * (r log r - r + 1))
under one token constraint for each source, sum(size * r) = target. Its convex dual has one variable for
each source (a constraint names one source, so the dual falls apart by source and ends at log(target / size)), rates are exponentially
tilted, r = exp(lambda of the source), and each Newton step is one distributed sum over the documents (over their counts by source and size, which is what the sums need).
Rates become whole copies: every document gets floor(r), and a carry that runs through each source from the
longest size to the shortest decides how many documents of each size get one more, so that a source ends
within about one short document of its target. Which documents of a size these are is dealt by a hash of
doc_id, in groups of bounded size, so that neither a hot source nor a hot size meets in one task.

Defined results: a null text has size 0; a null source is a source of its own, last in order; sources with
size 0 have target 0 and keep one copy of each (empty) document; null doc_ids and repeated rows are rows like any others; an empty
table gives an empty result; columns other than doc_id, text and source are ignored.
Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (5.0, 2.0, 1.0)
#: A target, and with it every document's rate, stops here.
CAP = 3
#: Rows of one size and source that are ranked together.
GROUP_ROWS = 256
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, src (the source as a key that is never null) and size, the number of words."""
    return docs.select(
        F.col("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~")).alias("src"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """src, source_size and target: all sizes shared by weight, none above cap times its source.

    Sources sorted by the level at which they stop form a prefix that is capped; what is left, shared by
    the other weights, gives the level of the rest, as repeated resharing would. One row for each source.
    """
    ranked = sources.withColumn("at", F.row_number().over(Window.orderBy("src")) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("stops", cap * F.col("source_size") / F.col("weight"))
    by = Window.orderBy("stops", "src")
    capped = F.coalesce(F.sum(cap * F.col("source_size")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", (total - capped) / rest)
    first = F.min_by("level", F.when(F.col("level") <= F.col("stops"), F.struct("stops", "src")))
    level = first.over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return ranked.select("src", "source_size", F.least(F.lit(1.0) * cap * F.col("source_size"), F.col("weight") * F.coalesce(level, "level")).alias("target"))


def rates(cells: DataFrame, wanted: DataFrame, cap: int = CAP, steps: int = 40, tolerance: float = 1e-10) -> DataFrame:
    """wanted with the rate of each source: Newton's method on the dual, one sum over cells (src, size, n) a step."""
    at = common.cut(wanted.withColumn("dual", F.lit(0.0)), "dual")
    for _ in range(steps):
        mass = cells.join(at.select("src", "dual"), "src").groupBy("src").agg(F.sum(F.col("n") * F.col("size") * F.exp("dual")).alias("mass"))
        # the gradient is target - mass and the curvature mass: the step is their quotient, kept within the trust region
        step = F.when((F.col("mass") > 0) & (F.col("target") > 0), F.greatest(F.lit(-2.0), F.least(F.lit(2.0), (F.col("target") - F.col("mass")) / F.col("mass")))).otherwise(F.lit(0.0))
        at = common.cut(at.join(mass, "src").select("src", "source_size", "target", (F.col("dual") + step).alias("dual"), F.abs(step).alias("moved")), "dual")
        if (at.agg(F.max("moved")).first()[0] or 0.0) < tolerance:
            break
    return at.select("src", "source_size", "target", F.least(F.lit(float(cap)), F.exp("dual")).alias("rate"))


def extras(cells: DataFrame, rated: DataFrame) -> DataFrame:
    """cells with the rate's whole part and how many of the n documents get one copy more.

    One list for each source holds its distinct sizes, whose number the longest document bounds.
    """
    whole = F.floor(F.col("rate") + 1e-9)
    lists = cells.groupBy("src").agg(F.reverse(F.array_sort(F.collect_list(F.struct("size", "n")))).alias("cells")).join(rated, "src")
    lists = lists.withColumn("whole", whole).withColumn("part", F.greatest(F.lit(0.0), F.col("rate") - whole))
    chosen = F.aggregate(
        "cells",
        F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<bigint>").alias("more")),
        lambda acc, c: _carried(acc, c, F.col("part")),
        lambda acc: acc["more"],
    )
    return lists.withColumn("more", chosen).select("src", "source_size", "target", "whole", F.explode(F.arrays_zip("cells", "more")).alias("z")).select("src", "source_size", "target", "whole", "z.cells.size", "z.cells.n", "z.more")


def _carried(acc, cell, part):
    due = acc["carry"] + part * cell["n"] * cell["size"]
    more = F.when(cell["size"] > 0, F.least(cell["n"], F.greatest(F.lit(0), F.round(due / cell["size"]).cast("bigint")))).otherwise(F.lit(0).cast("bigint"))
    return F.struct((due - more * cell["size"]).cast("double").alias("carry"), F.concat(acc["more"], F.array(more)).alias("more"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, src, size, source_size, target, copies and taken (copies times size) of every row of docs."""
    with common.scratch(docs.sparkSession):
        rows = common.cut(sized(docs), "sizes", keep=True)
        cells = common.cut(rows.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
        wanted = targets(cells.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, cap)
        chosen = common.cut(extras(cells, rates(cells, wanted, cap)), "copies", keep=True)

    n = common.partitions(docs.sparkSession)
    key = ["src", "size", "salt"]
    placed = rows.join(chosen, ["src", "size"]).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / GROUP_ROWS)))
    placed = placed.repartition(n, *key)
    groups = placed.where((F.col("more") > 0) & (F.col("more") < F.col("n"))).groupBy(*key).agg(F.count(F.lit(1)).alias("m"), F.first("more").alias("all_more"), F.first("n").alias("all_n"))
    upto = F.sum("m").over(Window.partitionBy("src", "size").orderBy("salt"))
    share = lambda x: F.floor(F.col("all_more") * x / F.col("all_n"))
    quotas = groups.withColumn("upto", upto).select(*key, (share(F.col("upto")) - share(F.col("upto") - F.col("m"))).alias("quota"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id"))
    ranked = placed.withColumn("place", place).join(quotas, key, "left")
    one = F.when(F.col("more") <= 0, 0).when(F.col("more") >= F.col("n"), 1).otherwise((F.col("place") <= F.coalesce("quota", F.lit(0))).cast("int"))
    copies = F.when(F.col("size") > 0, F.col("whole") + one).otherwise(F.lit(1)).cast("bigint")
    return ranked.select("doc_id", "src", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def apply(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """docs with every row as often as the mix takes it, its own columns unchanged."""
    columns, docs = docs.columns, common.packed(docs, "doc_id", "source", "text")
    key = ["__mix_id", "__mix_src", "__mix_size"]
    taken = mix(docs, weights, cap).groupBy(F.col("doc_id").alias("__mix_id"), F.col("src").alias("__mix_src"), F.col("size").alias("__mix_size")).agg(F.sum("copies").alias("__mix_copies"), F.count(F.lit(1)).alias("__mix_rows"))
    keyed = docs.withColumns({"__mix_id": F.col("doc_id"), "__mix_src": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~")), "__mix_size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")})
    on = keyed["__mix_id"].eqNullSafe(taken["__mix_id"]) & (keyed["__mix_src"] == taken["__mix_src"]) & (keyed["__mix_size"] == taken["__mix_size"])
    both = keyed.join(taken, on).drop(taken["__mix_id"]).drop(taken["__mix_src"]).drop(taken["__mix_size"])
    # rows that agree in all three share their copies evenly
    place = F.when(F.col("__mix_rows") == 1, 1).otherwise(F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("text"))))
    upto = lambda x: F.floor(F.col("__mix_copies") * x / F.col("__mix_rows"))
    both = both.withColumn("__mix_place", place).withColumn("__mix_times", (upto(F.col("__mix_place")) - upto(F.col("__mix_place") - 1)).cast("int"))
    return both.where("__mix_times > 0").withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_times")))).transform(common.unpacked, columns, "doc_id", "source", "text")
