"""Substring search by grams, held against every row."""

import random
import time

from pyspark.sql import functions as F

from scriptorium.operators import grams, publish, registry, search, semantic


def test_holding_equals_every_row_with_every_word(spark):
    rng = random.Random(2)
    letters = "abéß "
    hays = [(i // 2, "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))) for i in range(120)] + [(70, ""), (71, None), (72, "aaaa")]
    asked = [(i, ["".join(rng.choice(letters) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 3))]) for i in range(60)] + [(90, ["zzz"]), (91, ["aaa", "aaa"]), (92, [""])]
    got = grams.holding(spark.createDataFrame(hays, "k int, hay string"), "k", "hay", spark.createDataFrame(asked, "q int, words array<string>"), "q")
    want = sorted((k, q) for k, hay in hays for q, words in asked if hay is not None and all(w in hay for w in words))
    assert sorted((r.k, r.q) for r in got.collect()) == want
    none = spark.createDataFrame([], "q int, words array<string>")
    assert grams.holding(spark.createDataFrame(hays, "k int, hay string"), "k", "hay", none, "q").count() == 0


def test_long_texts_and_words_across_segments_and_passes(spark, monkeypatch):
    text = "é".join(str(i) for i in range(60_000))  # of 400,000 bytes, in which a search by characters counts from the beginning for each
    hays = [(1, text), (2, text[:1000]), (3, text[5:])]
    asked = [(1, ["59998é59999"]), (2, ["0é1é2é3é4é5é6é7é8é9é10é11"]), (3, ["59999", "0é1é2"]), (4, ["1é2é3", "20é21é22é23é25"])]
    monkeypatch.setattr(grams, "PER_PASS", 2)
    began = time.time()
    got = grams.holding(spark.createDataFrame(hays, "k int, hay string"), "k", "hay", spark.createDataFrame(asked, "q int, words array<string>"), "q").collect()
    assert sorted((r.k, r.q) for r in got) == sorted((k, q) for k, hay in hays for q, words in asked if all(w in hay for w in words))
    assert time.time() - began < 120


def test_no_nested_loop_in_the_search_for_many_queries(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"title {i}", f"text {i % 7}") for i in range(50)], "section_id int, title string, text string")
    queries = spark.createDataFrame([(1, "title text"), (2, " TEXT 3 "), (3, "  "), (4, "x")], "query_id int, query string")
    found = search.search_all(rows, queries)
    assert "NestedLoop" not in found._jdf.queryExecution().toString() and "Cartesian" not in found._jdf.queryExecution().toString()
    for q, words in ((1, "title text"), (2, "text 3")):
        want = [(r.section_id, r.score) for r in search.search(rows, words).collect()]
        assert [(r.section_id, r.score) for r in found.where(F.col("query_id") == q).orderBy("rank").collect()] == want


def test_long_lists_of_topics_give_the_same(spark, monkeypatch):
    topics = spark.createDataFrame([("a", 2, ["alpha", "be"]), ("b", 1, ["gamma ray"]), ("c", 3, ["a"]), ("d", 9, [])], "topic_id string, priority int, terms array<string>")
    sections = spark.createDataFrame([(1, "Alpha"), (2, "Gamma-Ray alpha"), (3, "beta"), (4, "zzz"), (5, "A"), (5, "zzz"), (6, None)], "section_id int, title string")
    short = sorted(tuple(r) for r in semantic.topic_members(topics, sections).collect())
    monkeypatch.setattr(semantic, "TOPICS", 2)
    assert sorted(tuple(r) for r in semantic.topic_members(topics, sections).collect()) == short and len(short) == 4


def test_images_stay_where_links_go(spark):
    docs = spark.createDataFrame([("x.md", r"![mine](gone.png) and [mine](gone.png), [a\Eb$1](no.md)")], "path string, text string")
    out = publish.neutralise_links(docs, spark.createDataFrame([], "path string")).first()
    assert out.text == r"![mine](gone.png) and mine, a\Eb$1" and out.neutralised == 2


def test_entities_of_one_id_have_a_defined_one(spark):
    none = spark.createDataFrame([], "concept_id string, canonical_term string")
    topics = spark.createDataFrame([("t", "b"), ("t", "a"), ("u", "c")], "topic_id string, label string").repartition(3)
    variants = spark.createDataFrame([("t", "0", "en")], "variant_id string, canonical_name string, language string")
    citations = spark.createDataFrame([], "citation_target_id string, anchor string, language string")
    got = {r.entity_id: (r.kind, r.label) for r in semantic.entities(topics, none, variants, citations).collect()}
    assert got == {"t": ("language_variant", "0"), "u": ("topic", "c")}


def test_public_paths_of_other_folders(spark):
    records = spark.createDataFrame([(1, "m/a.png", None, "s"), (2, "b.png", None, "s")], "volume int, media_file string, public_path string, public_asset_sha256 string")
    shipped = spark.createDataFrame([(1, "a.png", "s", "s"), (2, "b.png", "s", "t")], "volume int, name string, sha256 string, allowed_sha256 string")
    got = {r.volume: (r.public_path, r.public_asset_sha256) for r in registry.public_paths(records, shipped, "band-", "media").collect()}
    assert got == {1: ("band-1/media/a.png", "s"), 2: (None, None)}
