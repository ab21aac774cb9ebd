"""Toxicity of documents from averaged subword vectors and a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its character n-grams (with a mark at either end), so that a
misspelling no label ever showed still shares most of its vectors with words that one did. Vectors are averaged over
passages of PASSAGE words, each overlapping the next by half (short ones are filled up with zero vectors), and go through a linear softmax; a
document is as toxic as its worst passage, so length does not dilute a score. Training looks at every passage
with its document's label first, then at the worst passage of each document.

The sample is bounded: SAMPLE documents of either label, those with the smallest hash of doc_id among the labelled,
not held out, documents of at most SAMPLE_CHARS characters, each whole. Scoring reads every text whole.
At scoring only each n-gram's part of the logit is needed: one table of 2**BITS numbers, the same size for any input.

Defined results: a null or empty text gets the score of an empty passage; null doc_ids are scored and not held out
(they have no remainder); rows with equal doc_id are scored each, share a label, and stand in training with the first of their texts in order; repeated labels count once, as toxic if one of them is;
without labels of both kinds every score is the share of toxic labels seen, smoothed; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE = 1500
SAMPLE_CHARS = 10_000
GRAMS = (3, 4, 5)
BITS = 18
DIM = 4
PASSAGE = 24
FOLDS = 5
SLICE_BYTES = 1 << 20

_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def remainder(doc_id):
    """crc32 of doc_id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


class Words:
    """The words of some texts as one array of bytes, a space before, between and behind them."""

    def __init__(self, texts: list[str]):
        self.per_text, joined = np.zeros(len(texts), np.int64), []
        for i, t in enumerate(texts):
            words = t.lower().encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
            if words:
                self.per_text[i] = len(words)
                joined.append(b" ".join(words))
        self.bytes = np.frombuffer(b" " + b" ".join(joined) + b" ", np.uint8)
        self.spaces = np.flatnonzero(self.bytes == 32)
        self.n = int(self.per_text.sum())

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length of n-gram the bucket at every byte, and whether an n-gram of one word begins there."""
        ends = np.repeat(self.spaces[1:], np.diff(self.spaces))
        at = np.arange(len(ends))
        x = np.concatenate([self.bytes.astype(np.uint32), np.zeros(max(GRAMS), np.uint32)])
        h = np.zeros(len(ends), np.uint32)
        for i in range(max(GRAMS)):
            h = h * np.uint32(16777619) ^ x[i : i + len(ends)]
            if i + 1 in GRAMS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
                yield mixed >> np.uint32(32 - BITS), ends >= at + i

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word of every passage, which of them go on for a second half, and for every text its number of passages."""
        per = -(-self.per_text // (PASSAGE // 2))
        first = np.repeat(np.cumsum(self.per_text) - self.per_text, per)
        ends = np.cumsum(per)
        goes_on = np.ones(len(first), bool)
        goes_on[ends[per > 0] - 1] = False
        return first + PASSAGE // 2 * (np.arange(len(first)) - np.repeat(ends - per, per)), goes_on, per


def with_next(halves: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
    """Sums over passages from sums over their first halves."""
    out = halves.copy()
    at = np.flatnonzero(goes_on)
    out[at] += halves[at + 1]
    return out


class Model:
    """table: each n-gram's part of the logit; bias: the logit of an empty passage."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table.astype(np.float32), float(bias)

    def logits(self, texts: list[str]) -> np.ndarray:
        words = Words(texts)
        out = np.full(len(texts), self.bias)
        if not words.n:
            return out
        total, count = np.zeros(words.n), np.zeros(words.n)
        for bucket, valid in words.grams():
            total += np.add.reduceat(self.table[bucket] * valid, words.spaces[:-1], dtype=np.float64)
            count += np.add.reduceat(valid, words.spaces[:-1], dtype=np.int64)
        first, goes_on, per = words.passages()
        passage = with_next(np.add.reduceat(total / count, first), goes_on) / PASSAGE + self.bias
        some = np.flatnonzero(per)
        out[some] = np.maximum.reduceat(passage, (np.cumsum(per) - per)[some])
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -50, 50)))


def train(texts: list[str], toxic: np.ndarray, seed: int = 1, all_steps: int = 20, worst_steps: int = 100, rate: float = 0.1, min_texts: int = 3, decay: float = 1e-4) -> Model:
    """Fit on whole texts with labels 0 and 1; n-grams of fewer than min_texts texts keep zero vectors."""
    toxic = np.asarray(toxic, float)
    prior = np.log((toxic.sum() + 1) / (len(toxic) - toxic.sum() + 1))
    words = Words(texts)
    if toxic.min(initial=1) == toxic.max(initial=0) or not words.n:
        return Model(np.zeros(1 << BITS), prior)

    # every distinct word once, as a run of n-gram buckets
    seen: dict[bytes, int] = {}
    cuts = words.spaces[:: 1 << 16].tolist()
    word = np.fromiter((seen.setdefault(w, len(seen)) for a, b in zip(cuts, [*cuts[1:], len(words.bytes)]) for w in words.bytes[a:b].tobytes().split()), np.int32, words.n)
    distinct = Words([])
    distinct.bytes = np.frombuffer(b" " + b" ".join(seen) + b" ", np.uint8)
    distinct.spaces = np.flatnonzero(distinct.bytes == 32)
    n_words, n_seen = words.n, len(seen)
    owner = np.repeat(np.arange(n_seen, dtype=np.int32), np.diff(distinct.spaces))
    grams = [(b[v].astype(np.int32), owner[v]) for b, v in distinct.grams()]
    bucket, of = (np.concatenate(x) for x in zip(*grams))
    del seen, distinct, owner, grams
    by = np.argsort(of, kind="stable")
    bucket, of = bucket[by], of[by]
    del by
    count = np.bincount(of)
    first, goes_on, per = words.passages()
    second = np.flatnonzero(goes_on) + 1
    text_of = np.repeat(np.arange(len(texts)), per)
    spread = _texts_of(bucket, of, word, np.repeat(np.arange(len(texts)), words.per_text), n_seen, len(texts))
    del words
    often = spread[bucket] >= min_texts
    bucket, of = bucket[often], of[often]
    used, bucket = np.unique(bucket, return_inverse=True)
    bucket = bucket.astype(np.int32)
    starts, with_grams = np.flatnonzero(np.diff(of, prepend=-1)), np.unique(of)
    lengths = np.diff(np.append(first, n_words))
    some = np.flatnonzero(per)
    text_first = (np.cumsum(per) - per)[some]

    rng = np.random.default_rng(seed)
    params = {"e": rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32), "w": rng.normal(0, 1, (DIM, 2)), "b": np.zeros(2)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    for step in range(all_steps + worst_steps):
        e, w, b = params["e"], params["w"], params["b"]
        vectors = np.zeros((n_seen, DIM), np.float32)
        vectors[with_grams] = _sums(e, bucket, starts) / count[with_grams, None].astype(np.float32)
        means = with_next(np.add.reduceat(vectors[word], first), goes_on) / np.float32(PASSAGE)
        logits = means @ w + b
        toxicity = 1 / (1 + np.exp(-np.clip(logits[:, 1] - logits[:, 0], -50, 50)))
        weight = np.zeros(len(first))
        if step < all_steps:
            weight[:] = 1 / per[text_of]
        else:
            top = np.maximum.reduceat(toxicity, text_first)
            is_top = toxicity == np.repeat(top, per[some])
            weight[is_top] = (1 / np.add.reduceat(is_top, text_first, dtype=float))[np.searchsorted(some, text_of[is_top])]
        error = weight * (toxicity - toxic[text_of]) / len(texts)
        d_logits = np.stack([-error, error], 1)
        d_means = (d_logits @ w.T / PASSAGE).astype(np.float32)
        d_halves = d_means.copy()
        d_halves[second] += d_means[second - 1]
        d_vectors = np.repeat(d_halves, lengths, axis=0)
        d_vectors = np.stack([np.bincount(word, d_vectors[:, d], n_seen) for d in range(DIM)], 1) / count[:, None]
        d_e = np.stack([np.bincount(bucket, d_vectors[of, d], len(used)) for d in range(DIM)], 1)
        gradients = {"e": (d_e + decay * e).astype(np.float32), "w": means.T.astype(float) @ d_logits, "b": d_logits.sum(0)}
        for k, g in gradients.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            scale = np.sqrt(v / (1 - 0.99 ** (step + 1))) + 1e-8
            params[k] = params[k] - (rate * (m / (1 - 0.9 ** (step + 1))) / scale).astype(params[k].dtype)
    table = np.zeros(1 << BITS)
    table[used] = params["e"] @ (params["w"][:, 1] - params["w"][:, 0])
    return Model(table, params["b"][1] - params["b"][0])


def _sums(e: np.ndarray, bucket: np.ndarray, starts: np.ndarray, block: int = 1 << 14) -> np.ndarray:
    """Sums of e's rows over the runs of bucket that begin at starts, some runs at a time."""
    ends = np.append(starts, len(bucket))
    parts = [np.add.reduceat(e[bucket[ends[i] : ends[min(i + block, len(starts))]]], starts[i : i + block] - ends[i]) for i in range(0, len(starts), block)]
    return np.concatenate(parts) if parts else np.zeros((0, e.shape[1]), e.dtype)


def _texts_of(bucket: np.ndarray, of: np.ndarray, word: np.ndarray, text: np.ndarray, words: int, texts: int) -> np.ndarray:
    """For every bucket in how many texts it occurs, up to repetition by several words of one text."""
    pairs = np.unique(word.astype(np.int64) * texts + text)
    return np.bincount(bucket, np.bincount(pairs // texts, minlength=words)[of], 1 << BITS)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on a bounded sample of the labelled documents that are not held out."""
    with common.scratch(docs.sparkSession):
        texts, toxic = _sampled(docs, labels, sample)
    common.give_back()
    model = train(texts, toxic)
    del texts
    common.give_back()
    return model


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of the sample."""
    marked = labels.where("toxic IN (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    marked = marked.where(remainder(F.col("doc_id")) != 0)
    fits = F.length("text") <= SAMPLE_CHARS
    known = common.cut(docs.where(fits).select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().join(marked, "doc_id"), "labelled")
    picked = []  # 2 * sample rows at most
    for label in (0, 1):
        picked += known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    ids = F.broadcast(docs.sparkSession.createDataFrame([(r.doc_id, r.toxic) for r in picked], "_id bigint, toxic int"))
    rows = docs.where(fits).select(F.col("doc_id").cast("bigint").alias("_id"), "text").join(ids, "_id")
    rows = rows.groupBy("_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).orderBy("_id").toPandas()
    return rows.text.tolist(), rows.toxic.to_numpy()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of one fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            found = shared.value.scores(common.texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(remainder(F.col("doc_id").cast("bigint")) == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """docs without the rows that the model rejects, columns unchanged."""
    shared, columns = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            yield batch.filter(pa.array(shared.value.scores(common.texts(batch.column("text"))) < 0.5))

    return docs.mapInArrow(run, docs.schema).select(*columns)
