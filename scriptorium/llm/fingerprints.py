"""Exact fingerprints of documents in canonical form.

The canonical form of a text is its NFKC normalisation, case folded, with every run of white space one space
and none at the ends. Its fingerprint is the 128-bit XXH3 of the form's bytes. Inside buckets of equal digests
the bytes themselves are compared; should two forms ever share a digest, the fingerprints of that bucket carry
the start of their SHA-256 as well, so that fingerprints are equal if and only if the canonical forms are.
Likeness of two exact fingerprints is 1.0 or 0.0.

edited() pairs each document with the next by ascending doc_id. The order is cut at quantiles of doc_id; the first
document of each range is also sent to the range before, so texts move once and no range is gathered with another.

Defined results: a null text is empty; a null doc_id comes first; rows with equal doc_id follow each other by text,
and if a whole range has one doc_id it stays together; after the last document comes the first; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SLICE_BYTES = 2 << 20
#: Bytes of canonical forms that a task holds to compare others with.
HELD_BYTES = 16 << 20


def canonical(text: str) -> bytes:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return " ".join(text.split()).encode("utf-8", "surrogatepass")


def digest(form: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(form)


def edit(text: str, following: str) -> str:
    """text with its last half, rounded down, replaced by as many code points of the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranged(docs: DataFrame) -> DataFrame:
    """bucket, role, doc_id and text in order of bucket, role, id and text, a bucket in one partition.

    A bucket is a range of ids. Role 0 are its own documents, role 1 the first of the next bucket (of the
    first bucket, after the last).
    """
    spark = docs.sparkSession
    n = common.partitions(spark)
    id_ = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(common.NULL_ID))
    ids = docs.select(id_.alias("id"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = sorted(set(ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10_000)).first()[0] or [])) if n > 1 else []
    placed = ids.withColumn("bucket", _place(F.col("id"), cuts))
    firsts = placed.groupBy("bucket").agg(F.min("id").alias("first")).orderBy("bucket").collect()  # a row for each bucket
    before = [(b["first"], a["bucket"]) for a, b in zip(firsts[-1:] + firsts[:-1], firsts)]
    ahead = F.broadcast(spark.createDataFrame(before, "_first bigint, ahead int"))
    own = F.struct(F.col("bucket").alias("to"), F.lit(0).alias("role"))
    targets = F.when(F.col("ahead").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("ahead").alias("to"), F.lit(1).alias("role"))))
    rows = placed.join(ahead, F.col("id") == F.col("_first"), "left").select("id", "doc_id", "text", F.explode(targets).alias("t"))
    rows = rows.select(F.col("t.to").alias("bucket"), "t.role", "id", "doc_id", "text")
    rows = rows.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("bucket", "role", "id", "text")
    return rows.select("bucket", "role", "doc_id", "text")


def _place(value, cuts: list[int]):
    """How many of the sorted cuts lie below value, looked up in two steps of about the root of their number."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts)) + 1
    below = lambda array: F.size(F.filter(array, lambda c: c < value))
    group = F.greatest(F.lit(0), below(F.array(*map(F.lit, cuts[::width]))) - 1)
    return group * width + below(F.slice(F.array(*map(F.lit, cuts)), group * width + 1, width))


_PASS = "doc_id bigint, n_chars bigint, edited_sha256 string, digest string, sha string, edited_digest string, edited_sha string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch], hasher=digest) -> Iterator[pa.RecordBatch]:
    """For each document of _ranged what _PASS names, against the document that follows."""
    held, last, out = None, None, []

    def row(doc_id, text, form, following, next_form):
        changed = edit(text, following)
        changed_form = form if changed == text else canonical(changed)
        sha = hashlib.sha256
        return (
            doc_id, len(text), sha(changed.encode("utf-8", "surrogatepass")).hexdigest(), hasher(form), sha(form).hexdigest()[:32],
            hasher(changed_form), sha(changed_form).hexdigest()[:32], float(form == changed_form), float(form == next_form),
        )

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), *[pa.string()] * 5, pa.float64(), pa.float64()])], names=[x.split()[0] for x in _PASS.split(", ")])

    for batch in common.slices(batches, "text", SLICE_BYTES):
        for bucket, role, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("bucket", "role", "doc_id", "text")]):
            if bucket != last:
                held, last = None, bucket
            if role == 1 and held is None:
                continue
            form = canonical(text)
            if held is not None:
                out.append(row(*held, text, form))
            held = (doc_id, text, form) if role == 0 else None
        if out:
            yield packed(out)
            out = []
        common.give_back()


def edited(docs: DataFrame, hasher=digest) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    found = common.cut(_ranged(docs).mapInArrow(lambda b: _compare(b, hasher), _PASS), "fingerprints")
    split = colliding(docs, found, hasher)
    rows = found
    for column, sha in (("digest", "sha"), ("edited_digest", "edited_sha")):
        side = split.select(F.col("digest").alias("_split"))
        rows = rows.join(side, rows[column] == side["_split"], "left").withColumn(column, F.when(F.col("_split").isNull(), F.col(column)).otherwise(F.concat_ws("-", column, sha))).drop("_split")
    return rows.select("doc_id", "n_chars", "edited_sha256", F.col("digest").alias("fingerprint"), F.col("edited_digest").alias("edited_fingerprint"), "near_edited", "near_next")


def colliding(docs: DataFrame, found: DataFrame, hasher=digest) -> DataFrame:
    """The digests that stand for more than one canonical form: bytes compared inside every bucket of several documents.

    An edited text is no document: its form's SHA-256 is compared with those of its bucket.
    """
    buckets = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ids = common.small(common.cut(common.lookup(found.select("digest", "doc_id"), buckets, "digest", "n", found.count()).select(F.col("doc_id").alias("_id")).distinct(), "ids"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, bytes] = {}  # a form that equals the one its task sent for the digest need not go again
        held = 0
        for batch in common.slices(batches, "text", SLICE_BYTES):
            out = []
            for form in map(canonical, common.texts(batch.column("text"))):
                key = hasher(form)
                if seen.get(key) == form:
                    continue
                out.append((key, form))
                if key not in seen:
                    if held > HELD_BYTES:
                        seen, held = {}, 0
                    seen[key] = form
                    held += len(form)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.string()), pa.array([f for _, f in out], pa.binary())], names=["digest", "form"])
            common.give_back()

    compared = rows.mapInArrow(forms, "digest string, form binary").groupBy("digest").agg(F.min("form").alias("a"), F.max("form").alias("b"))
    apart = compared.where("a <> b").select("digest")
    both = found.select("digest", "sha").union(found.where("digest <> edited_digest").select("edited_digest", "edited_sha"))
    mixed = both.groupBy("digest").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).where("a <> b").select("digest")
    return common.cut(apart.union(mixed).distinct(), "collisions")
