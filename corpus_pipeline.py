"""From raw documents to token ids: toxicity, near-duplicates, repeated passages, mixing of sources, encoding.

Each stage takes (spark, docs, sf_dir) and returns what goes on; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import common, mixing, near_copies, pieces, suffix_dedup, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels outside the held-out fold, does not call toxic."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that links of similarity 0.8 over runs of five words connect."""
    return near_copies.keep_first(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that a document of smaller id holds in 50 or more together."""
    return suffix_dedup.cleaned(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    back = pieces.round_trip(docs, path, with_ids=True)
    return back.select("doc_id", "n_tokens", "ids", (F.xxhash64("text") == F.col("digest")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("tokens", tokenise),
]

#: No SQL can express the stages; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written to the shared folder and read again by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
