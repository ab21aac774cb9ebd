"""Near-duplicates by SimHash fingerprints that differ in few bits, compared exactly, tile by tile.

Distinct fingerprints lie in cells, and large cells are cut into tiles of bounded size by a hash. Tile pairs of cells that
no link can join are skipped, the others are compared whole with numpy exclusive-or and bit counts. A tile is
compared with itself once and then known by its components, so a tile pair returns the links that join components,
never all of them: their components are those of all links.

classes(): texts link where fingerprints of 64 bits differ in RADIUS bits or fewer. Cells are the population counts of the
four quarters: between linked fingerprints their differences add up to the radius at most. near_copies.py compares
wider fingerprints by the same tiles.

Defined results: a null or blank text has fingerprint zero, linked like any other; a null doc_id is carried
through and is no component's id unless the component has no other; equal rows share fingerprint and component; an empty
table gives an empty result; further columns are ignored. keep_first() keeps every row without doc_id, and of rows with one
doc_id one with the smallest hash of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, components

SEED = 42
WORDS = 3
RADIUS = 2
#: Fingerprints of a tile, and rows of it compared at once.
TILE, ROWS = 2048, 16
SLICE_BYTES = 1 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: For each byte its bits, each in a byte of its own.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def shingle_hashes(text: str, words: int = WORDS) -> list[int]:
    """XXH64 of every run of words, A-Z in lower case, joined by single spaces."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return []
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(joined, SEED)]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(found) - words + 1].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]


def majority(values: np.ndarray) -> np.ndarray:
    """Of rows of 64-bit numbers, the bits that are set in over half of them, as one such row."""
    n, width = values.shape
    counts = np.zeros(64 * width, np.int64)
    for i in range(0, n, 255 * 64):  # a lane counts to 255
        lanes = _LANES[values[i : i + 255 * 64].view(np.uint8).reshape(-1, 8 * width)]
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += sums.view(np.uint8).reshape(len(sums), -1).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > n, bitorder="little").view(np.uint64)


def fingerprint(text: str, words: int = WORDS) -> int:
    return int(majority(np.array(shingle_hashes(text, words), np.uint64)[:, None])[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a bigint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            fps = np.array([fingerprint(t, words) for t in common.texts(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


# comparison by tiles


def hits(a: np.ndarray, b: np.ndarray | None, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a and of b (of a itself, each pair once, if b is None) within radius, nearest first, in bounded portions.

    Counts are bytes: were all of 256 bits to differ, the pair would count as equal, which near_copies.py refuses by the texts.
    """
    left = np.ascontiguousarray(a.T)
    right = left if b is None else np.ascontiguousarray(b.T)
    for i in range(0, len(a), ROWS):
        skip = i if b is None else 0
        total = np.bitwise_count(left[0, i : i + ROWS, None] ^ right[0, None, skip:])
        for x, y in zip(left[1:], right[1:]):
            total += np.bitwise_count(x[i : i + ROWS, None] ^ y[None, skip:])
        u, v = np.nonzero(total <= radius)
        if b is None and len(u):
            later = v > u
            u, v = u[later], v[later]
        if len(u):
            d = total[u, v]
            near = np.argsort(d, kind="stable")
            yield u[near] + i, v[near] + skip, d[near]


def _up(root: np.ndarray) -> np.ndarray:
    """Every node to the root of its tree."""
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root = up


def forest(a: np.ndarray, b: np.ndarray | None, root: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (places u, v; those of b behind those of a) that join what root has apart, and the roots then; a root is its tree's first place."""
    us, vs = [], []
    for u, v, _ in hits(a, b, radius):
        if b is not None:
            v = v + len(a)
        while True:
            ru, rv = root[u], root[v]
            apart = ru != rv
            if not apart.any():
                break
            u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
            high, first = np.unique(np.maximum(ru, rv), return_index=True)
            root[high] = np.minimum(ru, rv)[first]
            us.append(u[first])
            vs.append(v[first])
            root = _up(root)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *us]), np.concatenate([none, *vs]), root


def edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def tile_links(rows: DataFrame, steps: list[int], radius: int, tile: int = TILE) -> DataFrame:
    """Links (u, v) of rows (node, w: array of 64-bit words, cell: few in number) whose components are those of all links.

    steps: by how much the cell of a link's one end is greater than the other's, of each two opposite steps one.
    """
    sizes = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    sizes = F.broadcast(common.cut(sizes, "cells"))  # cells are bounded in number by what defines them, whatever the input
    placed = rows.join(sizes, "cell").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    packed = placed.groupBy("cell", "salt").agg(F.collect_list(F.struct("node", "w")).alias("m")).select("cell", "salt", F.col("m.node").alias("nodes"), F.flatten("m.w").alias("words"))

    def words(values: pa.Scalar, n: int) -> np.ndarray:
        return np.asarray(values.values).view(np.uint64).reshape(n, -1)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for nodes, w in zip(batch.column("nodes"), batch.column("words")):
                ids = np.asarray(nodes.values)
                u, v, root = forest(words(w, len(ids)), None, np.arange(len(ids)), radius)
                found.append((root, ids[u], ids[v]))
            lists = [pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=["cell", "salt", "nodes", "words", "roots", "us", "vs"])

    tiles = common.cut(packed.mapInArrow(within, "cell int, salt int, nodes array<bigint>, words array<bigint>, roots array<bigint>, us array<bigint>, vs array<bigint>"), "tiles")
    inner = tiles.select(F.explode(F.arrays_zip("us", "vs")).alias("e")).select(F.col("e.us").alias("u"), F.col("e.vs").alias("v"))

    sides = ["nodes", "words", "roots"]
    pairs = tiles.select("cell", "salt", *sides, F.explode(F.array(*map(F.lit, steps))).alias("step")).withColumn("to_cell", F.col("cell") + F.col("step"))
    pairs = pairs.join(sizes.select(F.col("cell").alias("to_cell"), "tiles"), "to_cell").withColumn("to_salt", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = pairs.where((F.col("step") != 0) | (F.col("salt") < F.col("to_salt")))
    right = tiles.select(F.col("cell").alias("to_cell"), F.col("salt").alias("to_salt"), *[F.col(c).alias(f"to_{c}") for c in sides])

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, w, r, to_n, to_w, to_r in zip(*[batch.column(c) for c in (*sides, *[f"to_{c}" for c in sides])]):
                a, b = np.asarray(n.values), np.asarray(to_n.values)
                ids = np.concatenate([a, b])
                u, v, _ = forest(words(w, len(a)), words(to_w, len(b)), np.concatenate([np.asarray(r.values), np.asarray(to_r.values) + len(a)]), radius)
                if len(u):
                    yield edges(ids[u], ids[v])

    met = pairs.join(right, ["to_cell", "to_salt"]).select(*sides, *[f"to_{c}" for c in sides])
    return inner.unionByName(met.mapInArrow(between, "u bigint, v bigint"))


# classes of 64-bit fingerprints


def _steps(radius: int) -> list[int]:
    """The differences of quarter counts within the radius, of each two opposite ones one, as differences of cells."""
    span = range(-radius, radius + 1)
    every = [(a, b, c, e) for a in span for b in span for c in span for e in span]
    return [((a * 64 + b) * 64 + c) * 64 + e for a, b, c, e in every if sum(map(abs, (a, b, c, e))) <= radius and (a, b, c, e) >= (0, 0, 0, 0)]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of distinct fp within radius bits."""
    q = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    cell = (((q[0] * 64 + q[1]) * 64 + q[2]) * 64 + q[3]).cast("int")  # 17 ** 4 cells at most
    return tile_links(distinct.select(F.col("fp").alias("node"), F.array("fp").alias("w"), cell.alias("cell")), _steps(radius), radius, tile)


def classes(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links reach) of every row."""
    with common.scratch(docs.sparkSession):
        rows = common.cut(fingerprints(docs, words), "fingerprints", keep=True)
        distinct = common.cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
        roots = components.labels(links(distinct.select("fp"), radius))
        rooted = common.cut(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "roots")
        ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
        named = common.cut(common.lookup(rooted, ids, "root", "members", rooted.count()).select("fp", "component_id", "n"), "named", keep=True)
    return common.lookup(rows, named, "fp", "n", rows.count()).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: that with the smallest doc_id; rows without doc_id stay."""
    kept = classes(docs.where("doc_id IS NOT NULL")).where("doc_id = component_id").select(F.col("doc_id").alias("__kept_id")).distinct()
    rows = docs.join(kept, docs["doc_id"].cast("bigint") == kept["__kept_id"]).withColumn("__text", F.xxhash64("text"))
    least = rows.groupBy("__kept_id").agg(F.min("__text").alias("__least")).withColumnRenamed("__kept_id", "__id")
    once = rows.join(least, (F.col("__kept_id") == F.col("__id")) & F.col("__text").eqNullSafe(F.col("__least"))).dropDuplicates(["__kept_id"])
    return once.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
