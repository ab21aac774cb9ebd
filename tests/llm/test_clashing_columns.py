"""Stages take columns of any name, and keep them."""

import pytest
from pyspark.sql import functions as F

from scriptorium.llm import mixing, near_copies, suffix_dedup, topk

NAMES = ["_at", "_node", "__at", "__node", "__id", "__digest", "__kept", "__mix_copies", "__mix_id", "rest", "at", "node", "size", "root", "a.b", "copies", "src"]


@pytest.mark.parametrize("stage", [near_copies.keep_first, suffix_dedup.cleaned, mixing.apply])
def test_any_extra_columns(spark, stage):
    rows = [(i, f"words of document {i} and more of them " + f"number {i} " * 12, "en", "s", 0) for i in range(4)] + [(9, "words of document 0 and more of them " + "number 0 " * 12, "en", "t", 0)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = plain.withColumns({n: F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")) for n in NAMES})
    out = stage(extra)
    assert out.columns == extra.columns
    got = out.collect()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got) == sorted((r.doc_id, r.text, r.n_chars) for r in stage(plain).collect())
    assert all(r[n] == f"{n}-{r.doc_id}" for r in got for n in NAMES)


def test_components_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e20]), (1, [1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.quantised(df).collect()
    edge = spark.createDataFrame([(0, [-(2.0**54)]), (1, [2.0**53])], "vec_id bigint, embedding array<double>")
    assert [r.v for r in topk.quantised(edge).orderBy("vec_id").collect()] == [[-(2**62)], [2**61]]
