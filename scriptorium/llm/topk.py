"""Exact top-k inner products by aggregation of sorted lists without random access.

Candidates are cut into tiles, each with one list of its rows sorted by value for every component. A query reads
each list from the end that suits its component's sign, in slabs. What was read adds to a row's score; the last
value read bounds what a row may still get from a list, the list's far end what it gets at least. When the k-th best lower
bound exceeds the upper bounds of all but FINAL times k rows, no outsider can qualify, and the scores of those few are
resolved in whole numbers. Until then reading goes on, to the lists' ends if need be, where bounds are the scores.
Tiles return their k best, and the best of those are the answer.

All queries of a block read the lists to the same depth: their bounds are products of the block with the values read, the
frontiers and the far ends. Every tile meets GROUP blocks of queries in a task, streamed one after the other.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without id;
vectors of other lengths than the query's are no candidates of it; a query's own id is no candidate;
ties go to the smaller id; repeated rows are candidates each, and a repeated query is answered once, for the least of its
vectors; scores are exact, and one beyond 64 bits raises OverflowError; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

K = 5
SCALE = 256
EVERY = 50
#: Rows of a tile of candidates and of a block of queries; blocks that a task brings to a tile.
TILE, BLOCK, GROUP = 8192, 256, 4
#: Reading stops when FINAL times k rows may still qualify. Lists are read to one row in FIRST, twice as far up to half, then by half of what is left.
FINAL, FIRST = 4, 8


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array<bigint> of floor(scale * x)) and dim of the rows that take part; a component beyond 64 bits is an error."""
    x = F.col("embedding").cast("array<double>")
    # NaN and the infinities fail the comparison below; Spark orders NaN above every number
    sound = F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(sound, F.lit(False)))
    # floor() would give the greatest whole number for any beyond it
    whole = lambda e: F.when(F.abs(e * scale) < F.lit(2.0**63), F.floor(e * scale)).otherwise(F.raise_error(F.lit("OverflowError: a component beyond 64 bits")).cast("bigint"))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, whole).alias("v"), F.size("embedding").alias("dim"))


def _packed(rows: DataFrame, per: int, name: str) -> DataFrame:
    """Rows dealt by a hash of their id into groups of about per rows of one length, each packed into one row."""
    sizes = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / per).cast("int").alias("groups"))
    dealt = rows.join(sizes, "dim").withColumn("group", F.pmod(F.xxhash64("vec_id"), F.col("groups")).cast("int"))
    return dealt.groupBy("dim", "group").agg(F.collect_list(F.struct("vec_id", "v")).alias("rows")).select("dim", F.col("group").alias(name), F.col("rows.vec_id").alias(f"{name}_ids"), F.flatten("rows.v").alias(f"{name}_v"))


class Tile:
    """Candidates with their sorted lists. resolved: rows whose scores were resolved after reading had stopped; read: parts of the lists read, by query."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[by], v[by]
        self.values = self.v.astype(np.float64)
        order = np.argsort(self.v, axis=0, kind="stable")  # a list of rows for each component, from the least value
        self.sorted = np.take_along_axis(self.values, order, 0)
        self.place = np.empty(order.shape, np.int32)
        np.put_along_axis(self.place, order, np.arange(len(v), dtype=np.int32)[:, None], 0)
        self.most = np.abs(self.sorted[[0, -1]]).max(0)
        self.resolved, self.read = 0, []

    def _depths(self) -> Iterator[int]:
        n, at = len(self.ids), 0
        while at < n:
            left = n - at
            at = max(1, n // FIRST) if at == 0 else 2 * at if 2 * at <= n // 2 else n if left <= max(1, n // 64) else at + (left + 1) // 2
            yield min(n, at)

    def bounds(self, up: np.ndarray, down: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all rows' scores (a column for each query, given as its positive and negative parts) at a depth."""
        n = len(self.ids)
        seen_up, seen_down = self.place >= n - depth, self.place < depth
        upper = np.where(seen_up, self.values, self.sorted[n - depth]) @ up + np.where(seen_down, self.values, self.sorted[depth - 1]) @ down
        lower = np.where(seen_up, self.values, self.sorted[0]) @ up + np.where(seen_down, self.values, self.sorted[-1]) @ down
        return lower, upper

    def best(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k highest of one query."""
        return self.best_of(np.array([query_id]), q[None, :], k)[0]

    def best_of(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and scores of the k highest, ties to smaller ids."""
        n, found = len(self.ids), [None] * len(query_ids)
        weights = queries.T.astype(np.float64)
        slack = 2.0**-40 * (np.abs(weights) * self.most[:, None]).sum(0)  # of sums of rounded products
        todo = np.arange(len(query_ids))
        for depth in self._depths():
            lower, upper = self.bounds(np.maximum(weights[:, todo], 0), np.minimum(weights[:, todo], 0), depth)
            own = self.ids[:, None] == query_ids[todo][None, :]
            lower[own] = upper[own] = -np.inf
            least = np.partition(lower, n - k, axis=0)[n - k] if n >= k else np.full(len(todo), -np.inf)
            live = (upper >= least - slack[todo]) & ~own
            ended = live.sum(0) <= FINAL * k if depth < n else np.ones(len(todo), bool)
            for i in np.flatnonzero(ended):
                found[todo[i]] = self._resolved(np.flatnonzero(live[:, i]), queries[todo[i]], k)
                self.read.append(depth / n)
            todo = todo[~ended]
            if not len(todo):
                break
        return found

    def _resolved(self, rows: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        self.resolved += len(rows)
        if float(np.abs(q.astype(np.float64)) @ self.most) < 2.0**62:
            scores = self.v[rows] @ q
        else:  # whole numbers of any size
            every = [sum(a * b for a, b in zip(row, q.tolist())) for row in self.v[rows].tolist()]
            if any(not -(2**63) <= s < 2**63 for s in every):
                raise OverflowError("a score is beyond 64 bits")
            scores = np.array(every, np.int64)
        first = np.lexsort((self.ids[rows], ~scores))[:k]  # ~x falls as x rises, for the least number as well
        return self.ids[rows][first], scores[first]


def search(candidates: DataFrame, queries: DataFrame, k: int = K, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best; both inputs as quantised() gives them."""
    once = queries.groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v", F.size("v").alias("dim"))
    right = common.cut(_packed(candidates, tile, "tile"), "tiles")
    left = common.cut(_packed(once, block, "block"), "blocks")
    met = ["dim", "tile", "part"]
    last = right.groupBy("dim").agg(F.max("tile").alias("last"))
    blocks = left.join(last, "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("tile"), F.floor(F.col("block") / GROUP).cast("int").alias("part"), F.lit(1).alias("kind"), F.col("block_ids").alias("ids"), F.col("block_v").alias("v"))
    parts = left.groupBy("dim").agg(F.floor(F.max("block") / GROUP).cast("int").alias("last"))
    tiles = right.join(parts, "dim").select("dim", "tile", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("part"), F.lit(0).alias("kind"), F.col("tile_ids").alias("ids"), F.col("tile_v").alias("v"))
    rows = tiles.unionByName(blocks).repartition(common.partitions(candidates.sparkSession), *met).sortWithinPartitions(*met, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for dim, kind, ids, v in zip(*[batch.column(c) for c in ("dim", "kind", "ids", "v")]):
                ids, v = np.asarray(ids.values), np.asarray(v.values).reshape(-1, dim.as_py())
                if kind.as_py() == 0:
                    held = Tile(ids, v)
                    continue
                out = [(np.full(len(found), query_id), found, scores) for query_id, (found, scores) in zip(ids, held.best_of(ids, v, k))]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    found = rows.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
