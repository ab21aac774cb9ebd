"""Near copies by wide SimHash fingerprints, each link confirmed by the exact Jaccard similarity of the texts' word shingles.

Texts link where the similarity of their distinct runs of WORDS words is SIMILARITY or more. Fingerprints have BITS bits,
compared tile by tile as simhash.py does; candidates differ in a quarter of the bits or fewer (WIDE). Two sets of similarity
0.8 differ in a bit with a chance of 0.152, so a link is missed with a chance below 0.0001 (below 0.01 for texts of 8 or 9 words).
Cells are ranges of the number of runs, which between linked texts differ by a quarter at most.

Tiles return candidates that join components, and each is confirmed by the texts. Where one is refused, its group is compared
once more, tile by tile, now with the sets of runs themselves: candidates between parts that are still apart are decided where
they meet, and tiles again return only links that join. So no candidate that matters is left out, and no step emits the pairs of a group.

Defined results: a null or blank text has no runs and is a copy of every other such text; one row of each component
stays, that of the smallest doc_id (null after every other), and of rows with this doc_id that of the smallest text hash;
equal rows are copies; rows with one doc_id and unrelated texts stay each; an empty table gives an empty result; columns are
unchanged. Texts are named by 64 bits of their hash: of n texts two are confused with a chance of n * n / 2**65.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, components, simhash

WORDS, SIMILARITY = 5, 0.8
#: Bits of a fingerprint, and in how many candidates differ at most.
BITS = 256
WIDE = BITS // 4
#: Ratio of sizes that a cell spans, and cells that linked texts lie apart at most.
SPAN = 1.05
REACH = math.ceil(math.log(1 / SIMILARITY) / math.log(SPAN))
#: Runs that a tile holds where the sets themselves are compared.
RUNS = 1 << 16
SLICE_BYTES = 1 << 20
_MIX = np.array([xxhash.xxh64_intdigest(str(i)) for i in range(BITS // 64)], np.uint64)


def shingles(text: str) -> np.ndarray:
    """Distinct hashes of the runs of WORDS words."""
    return np.unique(np.array(simhash.shingle_hashes(text, WORDS), np.uint64))


def wide_fingerprint(found: np.ndarray) -> np.ndarray:
    """BITS bits for a set of hashes; those of one hash are mixed from it."""
    mixed = (found[:, None] ^ _MIX) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return simhash.majority(mixed)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two arrays of distinct values; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def signatures(docs: DataFrame) -> DataFrame:
    """at (doc_id), node (64 bits of the text's hash), size (distinct runs) and w (the wide fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            sets = [shingles(t) for t in common.texts(batch.column("text"))]
            w = [wide_fingerprint(s).view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array(w, pa.list_(pa.int64()))], names=["at", "node", "size", "w"])

    return docs.select(F.col("doc_id").cast("bigint").alias("at"), _node(docs).alias("node"), "text").mapInArrow(run, "at bigint, node bigint, size bigint, w array<bigint>")


def _node(docs: DataFrame):
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (u, v) of nodes with ok, whether their texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "a", SLICE_BYTES):
            ok, last, left = [], None, None
            for u, a, b in zip(batch.column("u").to_pylist(), batch.column("a"), batch.column("b")):
                if u != last:
                    last, left = u, shingles(a.as_py())
                ok.append(similarity(left, shingles(b.as_py())) >= SIMILARITY)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(ok, pa.bool_())], names=["u", "v", "ok"])

    ends = common.small(common.cut(pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct(), "near-ends"))
    read = common.cut(texts.join(ends, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "near-texts")
    rows = pairs.join(read.select(F.col("node").alias("v"), F.col("text").alias("b")), "v").join(read.select(F.col("node").alias("u"), F.col("text").alias("a")), "u")
    return common.cut(rows.select("u", "v", "a", "b").mapInArrow(run, "u bigint, v bigint, ok boolean"), "near-links")


def _ordered(pairs: DataFrame) -> DataFrame:
    return common.cut(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "near-pairs")


def _joining(rows: DataFrame, per: int) -> DataFrame:
    """Links (u, v) of rows (grp, node, part, w, runs) that join parts of one grp; tiles hold about per runs."""
    sizes = rows.groupBy("grp").agg(F.ceil(F.sum(F.size("runs") + 1) / per).cast("int").alias("tiles")).where("tiles > 1")
    placed = rows.join(common.small(common.cut(sizes, "near-large")), "grp", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    packed = placed.groupBy("grp", "salt").agg(F.first("tiles").alias("tiles"), F.collect_list(F.struct("node", "part", "w", "runs")).alias("m"))
    sides = ["nodes", "parts", "words", "sizes", "runs"]
    values = [F.col("m.node"), F.col("m.part"), F.flatten("m.w"), F.transform("m", lambda x: F.size(x["runs"]).cast("bigint")), F.flatten("m.runs")]
    tiles = common.cut(packed.select("grp", "salt", "tiles", *[v.alias(c) for v, c in zip(values, sides)]), "near-tiles")
    pairs = tiles.withColumn("other", F.explode(F.sequence("salt", F.col("tiles") - 1)))
    right = tiles.select(F.col("grp").alias("_grp"), F.col("salt").alias("_salt"), *[F.col(c).alias(f"to_{c}") for c in sides])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, *lists in zip(*batch.columns):
                found = [np.asarray(x.values) for x in lists]
                u, v = joined(found[:5], None if same.as_py() else found[5:])
                if len(u):
                    yield simhash.edges(u, v)

    met = pairs.join(right, (F.col("grp") == F.col("_grp")) & (F.col("other") == F.col("_salt")))
    return met.select(F.col("salt") == F.col("other"), *sides, *[f"to_{c}" for c in sides]).mapInArrow(run, "u bigint, v bigint")


def joined(a: list[np.ndarray], b: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Links between nodes of tiles a and b (of a, if b is None) that join parts; a tile: nodes, parts, words, sizes, runs."""
    nodes, parts, sizes, runs = (np.concatenate([a[i], b[i]]) if b else a[i] for i in (0, 1, 3, 4))
    w = [t[2].view(np.uint64).reshape(len(t[0]), -1) for t in (a, b or a)]
    runs, ends = runs.view(np.uint64), np.cumsum(sizes)
    _, root = np.unique(parts, return_inverse=True)
    first = np.full(root.max(initial=-1) + 1, len(nodes))
    np.minimum.at(first, root, np.arange(len(nodes)))
    root, us, vs = first[root], [], []
    for x, y, _ in simhash.hits(w[0], w[1] if b else None, WIDE):
        y = y + len(a[0]) if b else y
        fit = (np.minimum(sizes[x], sizes[y]) >= SIMILARITY * np.maximum(sizes[x], sizes[y])) & (root[x] != root[y])
        x, y = x[fit], y[fit]
        for i in np.unique(x):
            others = y[x == i]
            others = others[root[others] != root[i]]
            if not len(others):
                continue
            left, n = runs[ends[i] - sizes[i] : ends[i]], sizes[others]
            both = np.zeros(len(others), np.int64)
            if sizes[i]:
                every = np.concatenate([runs[ends[j] - sizes[j] : ends[j]] for j in others])
                found = left[np.minimum(np.searchsorted(left, every), len(left) - 1)] == every
                both = np.add.reduceat(found, np.cumsum(n) - n, dtype=np.int64)
            for j in others[both >= SIMILARITY * (sizes[i] + n - both)]:
                if root[i] != root[j]:
                    us.append(nodes[i])
                    vs.append(nodes[j])
                    root[root == max(root[i], root[j])] = min(root[i], root[j])
    return np.array(us, np.int64), np.array(vs, np.int64)


def near_roots(nodes: DataFrame, texts: DataFrame, tile: int = simhash.TILE, per: int = RUNS) -> DataFrame:
    """node and root of those of nodes (node, size, w) whose texts have near copies; texts: node and text."""
    cell = F.when(F.col("size") > 0, F.floor(F.log(F.col("size").cast("double")) / math.log(SPAN))).otherwise(F.lit(-100)).cast("int")
    pairs = _ordered(simhash.tile_links(nodes.select("node", "w", cell.alias("cell")), list(range(REACH + 1)), WIDE, tile))
    tried = _confirmed(pairs, texts)
    parts = components.labels(tried.where("ok"))
    refused = tried.where("NOT ok")
    if refused.isEmpty():
        return parts
    # groups with a refused candidate: there other candidates may still join what is apart
    wide = components.labels(pairs)
    open_groups = common.cut(wide.join(refused.select(F.col("u").alias("node")), "node", "left_semi").select("root").distinct(), "near-groups")
    part = parts.select(F.col("node").alias("_node"), F.col("root").alias("part"))
    members = wide.join(common.small(open_groups), "root", "left_semi").select(F.col("root").alias("grp"), "node")
    members = members.join(nodes, "node").join(part, F.col("node") == F.col("_node"), "left").select("grp", "node", "w", F.coalesce("part", "node").alias("part"))
    members = common.cut(members, "near-open")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([shingles(t).view(np.int64) for t in batch.column("text").to_pylist()], pa.list_(pa.int64()))], names=["node", "runs"])

    found = texts.join(common.small(members.select("node")), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")).mapInArrow(run, "node bigint, runs array<bigint>")
    with common.batches_of(nodes.sparkSession, "16m"):
        more = common.cut(_joining(members.join(found, "node"), per), "near-more")
    return components.labels(tried.where("ok").select("u", "v").unionByName(more))


def keep_first(docs: DataFrame) -> DataFrame:
    """docs with one row of each component."""
    columns, docs = docs.columns, common.packed(docs, "doc_id", "text")
    own = {"__at": F.col("doc_id").cast("bigint"), "__node": _node(docs)}
    same = F.col("__at").eqNullSafe(F.col("_at")) & (F.col("__node") == F.col("_node"))
    with common.scratch(docs.sparkSession):
        gone, again = _decided(docs)
    rest = docs.withColumns(own).join(common.small(gone), same, "left_anti")
    # of equal rows that stay, one
    once = docs.withColumns(own).join(common.small(again), same, "left_semi").dropDuplicates(["__at", "__node"])
    return common.unpacked(rest.unionByName(once), columns, "doc_id", "text")


def _decided(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """_at and _node of the rows that go, and of those of them that stand for several equal rows of which one stays."""
    rows = common.cut(signatures(docs), "near-rows")
    nodes = common.cut(rows.groupBy("node").agg(F.first("size").alias("size"), F.first("w").alias("w")), "near-nodes")
    found = near_roots(nodes, docs.select(_node(docs).alias("node"), F.coalesce("text", F.lit("")).alias("text"))).select(F.col("node").alias("_node"), "root")
    pairs = rows.groupBy("at", "node").agg(F.count(F.lit(1)).alias("times"))
    pairs = common.cut(pairs.join(found, F.col("node") == F.col("_node"), "left").select("at", "node", "times", F.coalesce("root", "node").alias("root")), "near-roots")
    order = F.struct(F.col("at").isNull().alias("none"), "at", "node")
    first = pairs.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = common.cut(common.lookup(pairs, first, "root", "n", pairs.count()).where(~(order == F.col("first"))).select(F.col("at").alias("_at"), F.col("node").alias("_node")), "near-later")
    repeated = pairs.where("times > 1").select("at", "node")
    gone = common.cut(later.union(repeated).distinct(), "near-gone", keep=True)
    known = F.col("at").eqNullSafe(F.col("_at")) & (F.col("node") == F.col("_node"))
    again = repeated.join(later, known, "left_anti").select(F.col("at").alias("_at"), F.col("node").alias("_node"))
    return gone, common.cut(again, "near-again", keep=True)
