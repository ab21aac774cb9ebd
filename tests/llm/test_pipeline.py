from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from scriptorium.llm import common, mixing, suffix_dedup, toxicity
from tests.llm import test_near_copies

SF = "/root/testdata/sf0.001"


def brute_clean(rows):
    least, out = {}, []
    raw = [(i, t.encode()) for i, t in rows]
    for i, b in raw:
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            least[w] = min(i, least.get(w, i))
    for i, b in raw:
        gone = [False] * len(b)
        for p in range(len(b) - 49):
            if least[b[p : p + 50]] < i:
                gone[p : p + 50] = [True] * 50
        out.append((i, bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")))
    return out


def test_run_equals_brute_force(spark):
    docs = common.table(spark, SF, "documents")
    model = toxicity.fit(docs, common.table(spark, SF, "labels"))
    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]
    rows = [r for r, s in zip(rows, model.scores([r[1] for r in rows])) if s < 0.5]
    sources = {r[0]: r[2] for r in rows}
    first = set(test_near_copies.brute_kept([(i, t) for i, t, _ in rows]))
    cleaned = brute_clean([(i, t) for i, t, _ in rows if i in first])
    df = spark.createDataFrame([(i, t, sources[i]) for i, t in cleaned], "doc_id bigint, text string, source string")
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter({(i, tuple(sp.encode(t))): copies[i] for i, t in cleaned if copies[i]})
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) and r.round_trip for r in got)


def test_stages_keep_the_columns_and_stand_empty_and_odd_tables(spark):
    schema = common.table(spark, SF, "documents").schema
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "words here", "en", "s", 10), (3, "x" * 60_000 + " y", "en", None, 60_002), (3, "x" * 60_000 + " y", "en", None, 60_002), (4, "the same words " * 8, "fr", "s", 120), (5, "the same words " * 8, "fr", "t", 120)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.cut(stage(spark, docs, SF), name)
            assert docs.columns == schema.names, name
        clashing = spark.createDataFrame([(*r, 1, "k", 2.0, "t") for r in rows], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", id int, kept string, copies double, _id string")
        for name, stage in corpus_pipeline.STAGES:
            assert (stage(spark, clashing, SF).count() > 0) == bool(rows), name
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.count() == docs.count()
