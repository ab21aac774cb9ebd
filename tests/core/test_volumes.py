from pyspark.sql import functions as F

from scriptorium.functions import render
from scriptorium.operators import volumes


def test_old_schema_mutations(spark):
    units = spark.createDataFrame([("u1", "abcd", "p", 1, 2, ["1"]), ("u2", "ef", "p", 3, 3, [])], "id string, text string, source_sha256 string, pdf_page_start int, pdf_page_end_inclusive int, footnote_numbers array<string>").withColumn("source_text_hash", F.sha2("text", 256))
    chunks = spark.createDataFrame([("c1", "u1", 0, 3, "abc"), ("c2", "u1", 3, 4, "d"), ("c3", "u2", 0, 2, "ef")], "chunk_id string, unit_id string, start_char_in_unit int, end_char_in_unit int, text string")
    notes, pins = spark.createDataFrame([(1, "u1")], "n int, owner string"), spark.createDataFrame([("p",)], "source_sha256 string")
    rules = lambda *a: sorted({r.rule for r in volumes.old_volume_findings(*a).collect()})
    assert rules(units, chunks, notes, pins) == []
    assert rules(units.orderBy(F.desc("id")), chunks, notes, pins) == []
    assert rules(units.withColumn("text", F.concat("text", F.lit("x"))), chunks, notes, pins) == ["chunks_lose_text", "text_hash_mismatch"]
    assert rules(units, chunks.where("chunk_id <> 'c2'"), notes, pins) == ["chunks_lose_text"]
    assert rules(units, chunks.withColumn("text", F.upper("text")), notes, pins) == ["chunk_is_not_its_range"]
    assert rules(units, chunks, notes.union(spark.createDataFrame([(2, "u2"), (2, "u2")], notes.schema)), pins) == ["duplicate_footnote", "unowned_footnote"]
    assert rules(units, chunks, notes.limit(0), pins) == ["undefined_footnote"]
    assert rules(units.withColumn("source_sha256", F.lit("q")), chunks, notes, pins) == ["source_not_pinned"]
    assert rules(units.withColumn("pdf_page_start", F.lit(9)), chunks, notes, pins) == ["page_range"]


def test_small_operators(spark):
    rows = spark.createDataFrame([("a.PNG", "x.png"), ("b.wmf", "y.png")], "n string, s string")
    assert [r.t for r in rows.select(volumes.target_name(F.col("n"), F.col("s")).alias("t")).collect()] == ["a.PNG", "b.png"]
    body = "head\n\nshort\n\n" + "Long words, many " * 6 + "\n\n" + "z" * 200
    got = spark.createDataFrame([(body,)], "b string").select(volumes.line_context(F.col("b")).alias("c")).first().c
    assert got == [("longwordsmany" * 6)[:95], "z" * 95]
    concepts = spark.createDataFrame([("c1", ["t2", "t1", "tx"], ["c2", "c3"]), ("c2", [], [])], "concept_id string, related_topic_ids array<string>, related_concept_ids array<string>")
    topics = spark.createDataFrame([("t1", 1, "A"), ("t2", 2, "B")], "topic_id string, priority int, label string")
    found = {r.concept_id: (r.topics, r.related) for r in volumes.topic_labels(concepts, topics, spark.createDataFrame([("c3",)], "concept_id string")).collect()}
    assert found == {"c1": (["A", "B"], ["c3"]), "c2": ([], [])}
    items = spark.createDataFrame([("k", 1, None), ("k", 2, "p"), ("j", 1, None)], "k string, ord int, suggested_path string")
    assert {r.k: (r.ord, r.suggested_path) for r in volumes.suggested(items, "k", "ord").collect()} == {"k": (2, "p"), "j": (1, None)}
    filled = volumes.with_defaults(items, {"suggested_path": "none", "n": 0}).where("k = 'j'").first()
    assert (filled.suggested_path, filled.n) == ("none", 0)
    roots = spark.createDataFrame([("tom-1",), ("w",)], "w string").select(volumes.work_root(F.col("w")).alias("r")).collect()
    assert [r.r for r in roots] == ["tom-1", "works/w"]


def test_markdown(spark):
    source = "# T <x>\n\n**b** *e* ~~s~~ `c<` [l](u) ![i](p)[^1]\n\n- a\n- b\n\n1. x\n2. y\n\n> q\n\n|h|k|\n|-|-|\n|1|2|\n\n[^1]: note\n"
    out = spark.createDataFrame([(source,), (None,)], "t string").select(render.markdown_to_html("t").alias("h")).collect()
    assert out[1].h is None
    for part in ("<h1>T &lt;x&gt;</h1>", "<strong>b</strong> <em>e</em> <del>s</del> <code>c&lt;</code>", '<a href="u">l</a>', '<img src="p" alt="i">', "<ul><li>a</li><li>b</li></ul>", "<ol><li>x</li><li>y</li></ol>", "<blockquote><p>q</p></blockquote>", "<th>h</th>", "<td>2</td>", '<li id="fn-1">note'):
        assert part in out[0].h, part
