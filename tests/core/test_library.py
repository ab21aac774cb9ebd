import io
import json
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import media, paths, text
from scriptorium.operators import audit, catalog, gate, publish, registry, search, sections, semantic
from scriptorium.plans import registry_plans
from scriptorium.sources import readers, sinks
from scriptorium.streaming import ingest


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "column,value,want",
    [
        (text.norm_search, "Ёлка — «Снег»­!", "елка снег "),
        (text.fold_letters, "Straße ½ №5 Ё", "strasse12no5е"),
        (text.fold_alnum, "½a", "12a"),
        (text.squeeze, " #a *b*\n c ", "a b c"),
        (text.plain, "**a**[^1] [b](c) <i>d</i>", "a [b d"),
        (text.detag, "![x](y)[b](c) <i>d</i>[^2]", "b d"),
        (text.strip_front_matter, "---\na: b\n---\ntext", "text"),
        (text.media_marks, '<img src="a/b.png" w=1/> ![z](m/c.jpg){w}', "IMG[b.png] IMG[c.jpg]"),
        (text.tidy_title, 'A <img src="x"/>  B /', "A B"),
        (text.tidy_title, "A  /", "A  /"),
        (text.slug, "https://e.org/a/Ünï x?.html/", "ünï_x_.html"),
        (text.slug, "", "item"),
        (text.html_links, "[a](b/c.md) [d](e.md#f) [g](h.mdx)", "[a](b/c.html) [d](e.html#f) [g](h.mdx)"),
        (text.redact, "to a.b@c-d.org, ok", "to [email], ok"),
        (text.escape_html, "<a&\"'>", "&lt;a&amp;&quot;&#x27;&gt;"),
        (paths.percent_decode, "a%20b+c%zz", "a%20b+c%zz"),
        (paths.percent_decode, "a%20b+c", "a b+c"),
        (paths.html_path, "a/b.c/d.md", "a/b.c/d.html"),
        (paths.root_prefix, "a/b/c.md", "../../"),
    ],
)
def test_text_functions(spark, column, value, want):
    assert one(spark, column(F.col("v")), v=value) == want


def test_paths_and_small_functions(spark):
    assert one(spark, paths.relative(F.col("a"), F.col("b")), a="x/y/z.md", b="x/w/v.md") == "../w/v.md"
    assert one(spark, paths.relative(F.col("a"), F.col("b")), a="z.md", b="w/v.md") == "w/v.md"
    assert one(spark, paths.unit_path(F.col("a"), F.col("b")), a="chapter", b="ch-01") == "chapters/ch-01.md"
    assert one(spark, text.object_id(F.col("a"), F.col("b")), a="w", b="рис 1.png") == "w--рис_1"
    assert one(spark, text.with_title(F.col("a"), F.col("b")), a="no head", b="T") == "# T\n\nno head"
    assert one(spark, text.year(F.col("a"), F.col("b")), a="", b="1990") == "1990"
    assert one(spark, text.front_matter(F.col("a"), "k"), a='---\nj: 1\nk: "v w"\n---\n') == "v w"


def test_media_cascades(spark):
    rows = spark.createDataFrame([("Схема 1", ".png", "Схема 1"), ("фото автора", ".png", None), (None, ".wmf", None), ("обложка", ".jpg", None), (None, ".png", None)], "cap string, ext string, lab string")
    kind = media.media_type(F.col("cap"), F.col("ext"))
    got = rows.select(kind.alias("k"), media.rights(kind, F.col("cap"), F.lit(""), F.col("ext"), F.col("lab")).alias("r"), media.provenance(kind, F.col("cap"), F.col("lab"), F.lit(None).cast("string"), F.col("ext"))["class"].alias("p")).collect()
    assert [tuple(r) for r in got] == [
        ("scheme", "authorial", "authorial_scheme_or_diagram"), ("photo", "rights_review_required", "third_party_photo"), ("scheme", "authorial", "authorial_scheme_or_diagram"), ("cover", "rights_review_required", "cover_or_external_art"), ("other", "unknown", "unclear_after_second_pass"),
    ]


BOOK = "Титул\nОГЛАВЛЕНИЕ\nГлава 1\n# Предисловие\nслово\n# Глава 1. Первая\nтекст\n## 1.1. Раздел\nа\n### 1.1.2. Подраздел\nб\n# Приложение 3. Доп\n## 3.1. Раздел\nв\nОГЛАВЛЕНИЕ\n"


def test_units_are_lossless(spark):
    docs = spark.createDataFrame([(1, BOOK)], "doc_id bigint, text string")
    got = sections.units(docs).orderBy("unit_no").collect()
    assert [(r.kind, r.unit_id) for r in got] == [("front", "front"), ("original_toc", "toc"), ("preface", "preface"), ("chapter", "ch-01"), ("section", "ch-01-s01-01"), ("subsection", "ch-01-s01-01-02"), ("appendix", "ap-03"), ("section", "ap-03-s03-01")]
    assert "".join(r.raw for r in got) == BOOK
    assert got[3].title == "Глава 1. Первая" and got[3].path == "chapters/ch-01.md"
    parts = sections.split_by_headings(spark.createDataFrame([(1, "lead\n# A\nx\n## B\ny")], "doc_id int, text string")).orderBy("section_no").collect()
    assert [(r.title, r.text) for r in parts] == [("text", "lead"), ("A", "# A\nx"), ("B", "## B\ny")]


def test_chunks_break_at_blank_lines(spark):
    body = "a" * 1500 + "\n\n" + "b" * 3000 + "\n\nend" + "c" * 4000
    docs = spark.createDataFrame([(1, body), (2, ""), (3, None), (4, "short")], "doc_id int, text string")
    chunked = sections.chunks(docs)
    got = {}
    for r in chunked.collect():
        got.setdefault(r.doc_id, []).append((r.chunk_no, r.start_char, r.end_char, r.text))
    assert "".join(x[3] for x in sorted(got[1])) == body and sorted(got[1])[0][2] == 1502 and set(got) == {1, 4}
    assert all(r.n_gaps == 0 for r in sections.contiguity(chunked).collect())
    broken = chunked.withColumn("start_char", F.when(F.col("chunk_no") == 1, F.col("start_char") + 1).otherwise(F.col("start_char")))
    assert sections.contiguity(broken).where("n_gaps > 0").count() == 1


def test_footnotes(spark):
    parts = spark.createDataFrame([("w", "s1", 1, "One[^1] nine[^9].\n\n[^1]: first\n"), ("w", "s2", 2, "Nine[^9].\n\n[^9]: ninth\nmore\n")], "work string, sec string, ord int, text string")
    out = {r.sec: (r.text, r.replicated) for r in sections.replicate_footnotes(parts, "work", "sec", "ord").collect()}
    assert out["s1"][1] == 1 and "[^9]: ninth\nmore" in out["s1"][0] and out["s2"][1] == 0
    rules = {(r.rule, r.detail) for r in sections.footnote_findings(parts.select(F.col("sec").alias("doc_id"), "text")).collect()}
    assert rules == {("undefined_footnote", "9")}


def test_search(spark):
    rows = spark.createDataFrame([(1, "Alpha beta", "gamma"), (2, "x", "alpha GAMMA"), (3, "gamma alpha", ""), (4, "none", None)], "section_id int, title string, text string")
    got = [(r.section_id, r.score) for r in search.search(rows, " alpha  gamma ").collect()]
    assert got == [(3, 20), (1, 11), (2, 2)]
    assert search.search(rows, "  ").count() == 0
    many = search.search_all(rows, spark.createDataFrame([(1, "alpha gamma"), (2, "none")], "query_id int, query string")).collect()
    assert sorted((r.query_id, r["rank"], r.section_id, r.score) for r in many) == [(1, 1, 3, 20), (1, 2, 1, 11), (1, 3, 2, 2), (2, 1, 4, 10)]


def test_registry(spark):
    records = spark.createDataFrame([("f1", "published", None), ("f2", "duplicate", "f1"), ("f3", "metadata_only_rights", None), ("f4", "duplicate", "f3")], "figure_id string, publication_status string, duplicate_of string")
    got = {r.figure_id: (r.effective_status, r.duplicate_blocked_by) for r in registry.effective_status(records).collect()}
    assert got == {"f1": ("published", None), "f2": ("published", None), "f3": ("metadata_only_rights", None), "f4": ("metadata_only_rights", "metadata_only_rights")}
    decided = registry.reclassified(records, spark.createDataFrame([("f3", "block", 1), ("f3", "promote", 2), ("f1", "block", 3)], "figure_id string, decision string, line_no int"))
    assert {r.figure_id: r.publication_status for r in decided.collect()} == {"f1": "metadata_only_rights", "f2": "duplicate", "f3": "published", "f4": "duplicate"}
    lines = spark.createDataFrame([("a.md", i, t) for i, t in enumerate(["x", "Рис. 2. Вид", "ref", "*подпись* рисунок 3", "y"])], "file string, line_no int, line string")
    refs = spark.createDataFrame([("r", "a.md", 2), ("s", "b.md", 0)], "ref_id string, file string, line_no int")
    assert {r.ref_id: r.label for r in registry.captions(refs, lines).collect()} == {"r": "Рис. 2.", "s": None}
    done = registry.insert_lines(spark.createDataFrame([("d", 0, "a"), ("d", 1, "b")], "k string, line_no int, line string"), spark.createDataFrame([("d", 0, "2", "y"), ("d", 0, "1", "x")], "k string, line_no int, item string, line string"), "k")
    assert done.first().text == "a\nx\ny\nb"
    marks = spark.createDataFrame([("m", "f", 10, "s"), ("n", "f", 500, "s"), ("o", "f", 500, "t")], "mark_id string, file string, line_no int, sha string")
    found = spark.createDataFrame([("f", 12, "s"), ("f", 9, "s"), ("f", 7, "t")], "file string, line_no int, sha string")
    assert {r.mark_id: r.line_no for r in registry.reanchor(marks, found).collect()} == {"m": 9, "o": 7}


BASE = spark_rows = [("s1", "ab", 1, 5), ("s2", "cd", 2, 6)]


def rules(df):
    return sorted({r.rule for r in df.collect()})


def test_section_validation_mutations(spark):
    secs = spark.createDataFrame(BASE, "section_id string, text string, reading_order int, page int").withColumn("sha256", F.sha2("text", 256)).withColumn("pdf_pages", F.lit(10))
    chunked = spark.createDataFrame([("s1", 0, 0, 2, "ab"), ("s2", 0, 0, 1, "c"), ("s2", 1, 1, 2, "d")], "section_id string, chunk_no int, start_char int, end_char int, text string")
    assert rules(audit.section_findings(secs, chunked)) == []
    change = lambda df, c, v, at="s1": df.withColumn(c, F.when(F.col("section_id") == at, F.lit(v)).otherwise(F.col(c)))
    assert rules(audit.section_findings(change(secs, "text", "xx"), chunked)) == ["chunks_lose_text", "text_hash_mismatch"]
    assert rules(audit.section_findings(change(secs, "page", 99), chunked)) == ["page_out_of_range"]
    assert rules(audit.section_findings(change(secs, "reading_order", 2), chunked)) == ["duplicate_reading_order"]
    assert rules(audit.section_findings(secs, chunked.where("chunk_no = 0"))) == ["chunks_lose_text"]
    assert rules(audit.section_findings(secs, change(chunked, "start_char", 1))) == ["chunk_gap"]
    assert rules(audit.section_findings(secs.where("section_id = 's1'"), chunked)) == ["orphan_chunk"]
    assert rules(audit.section_findings(secs, chunked.where("section_id = 's1'"))) == ["section_without_chunks"]


def test_sections_of_broken_encoding_or_no_text(spark):
    misread = ["Слово".encode().decode("latin-1"), "стр €".encode().decode("cp1252", "replace").replace("�", "\x81"), "no \ufffd"]
    sound = ["Ñ Ñ Ñ Ñ a", "ÑaÑoÑu ÐÐÐÐ", "«Ñ» Ñ¿Ñ¿Ñ¿", "Слово"]
    rows = [(f"{kind}{i}", t, i, 1, "") for kind, texts in (("a", misread), ("b", sound)) for i, t in enumerate(texts)]
    secs = spark.createDataFrame(rows, "section_id string, text string, reading_order int, page int, x string").withColumn("sha256", F.sha2("text", 256)).withColumn("pdf_pages", F.lit(10))
    chunked = secs.select("section_id", F.lit(0).alias("chunk_no"), F.lit(0).alias("start_char"), F.length("text").alias("end_char"), "text")
    found = audit.section_findings(secs, chunked).where("rule = 'broken_encoding'").collect()
    assert sorted(r.entity_key for r in found) == ["a0", "a1", "a2"]
    none = secs.withColumn("text", F.lit(None).cast("string")).withColumn("sha256", F.when(F.col("section_id") == "a0", "wrong"))
    assert [r.entity_key for r in audit.section_findings(none, chunked.limit(0)).where("rule = 'text_hash_mismatch'").collect()] == ["a0"]


def test_scanner_finds_what_is_hidden(spark):
    secret = b"write to someone@example.org now"
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + b"\0\0\0\0"
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"zTXt", b"k\0\0" + zlib.compress(secret))
    pdf = b"%PDF-1.4 stream\n" + zlib.compress(secret) + b"endstream"
    import base64

    files = [("a.png", png), ("b.pdf", pdf), ("c.txt", base64.b64encode(secret)), ("d.dat", secret.decode().encode("utf-16-le")), ("e.html", b"<script>x</script>"), ("ok.md", b"clean"), ("x_qa.md", b""), ("bad.png", b"not a png")]
    got = {(r.entity_key, r.rule) for r in audit.scan_files(spark.createDataFrame(files, "path string, content binary"), declared_pdfs=["b.pdf"]).collect()}
    assert got == {("a.png", "e-mail address"), ("b.pdf", "e-mail address"), ("c.txt", "e-mail address"), ("d.dat", "e-mail address"), ("e.html", "inline/foreign script tag"), ("x_qa.md", "forbidden_name")}


def test_links(spark):
    docs = spark.createDataFrame([("a/x.md", "[one](y.md) [two](../gone.md) [web](https://e.org) [mine](file:///c) ![i](p.png) [up](../../z.md)")], "path string, text string")
    out = publish.neutralise_links(docs, spark.createDataFrame([("a/y.md",), ("z.md",)], "path string")).first()
    assert out.text == "[one](y.md) two [web](https://e.org) mine ![i](p.png) up" and (out.kept, out.neutralised) == (2, 3)
    gone = publish.omit_images(docs, spark.createDataFrame([("a/x.md", "q.png")], "path string, name string"), "(image left out)").first()
    assert gone.omitted == 1 and "(image left out)" in gone.text


def test_gate(spark):
    flags = [True] * 6
    ok = registry_plans.approval(spark, flags)
    assert rules(gate.flag_findings(ok)) == [] and rules(gate.scope_findings(ok)) == []
    for i in range(6):
        for value in (False, None):
            given = registry_plans.approval(spark, [value if k == i else f for k, f in enumerate(flags)])
            assert [r.detail for r in gate.flag_findings(given).collect()] == [registry_plans.FLAGS[i]]
    none = registry_plans.approval(spark, [True, True, True, True, False, False], "none")
    assert rules(gate.flag_findings(none)) == []
    assert [r.detail for r in gate.flag_findings(registry_plans.approval(spark, [True, True, True, True, False, False], "none", "ship")).collect()] == ["rights_and_third_party_art_review"]
    assert rules(gate.scope_findings(registry_plans.approval(spark, flags, "some", "link", (), "http://x"))) == ["bad_pdf_url", "bad_scope_media", "no_volumes"]
    volumes = spark.createDataFrame([(1, 1, ["i"], 2)], "volume int, omitted_media int, not_placed array<string>, ole_objects int")
    media_queue = spark.createDataFrame([(1, "i", "pending", None)], "volume int, image string, human_review_status string, manual_decision string")
    ole = spark.createDataFrame([(1, "o", "verified"), (1, "o", "verified")], "volume int, saved_as string, human_review_status string")
    assert rules(gate.queue_findings(media_queue, volumes, ole, ok)) == ["media_pending", "ole_pending"]
    assert {r.severity for r in gate.queue_findings(media_queue, volumes, ole, none).collect()} == {"note"}
    done = ole.union(spark.createDataFrame([(1, "p", "verified")], ole.schema))
    assert rules(gate.queue_findings(media_queue.withColumn("human_review_status", F.lit("verified")), volumes, done, ok)) == []
    a = spark.createDataFrame([("assets/media/a", "1", "approved"), ("assets/media/b", "2", "approved"), ("../c", "3", "approved"), ("assets/media/a", "1", "approved")], "path string, sha256 string, decision string")
    shipped = spark.createDataFrame([("assets/media/a", "9"), ("assets/media/d", "4")], "path string, sha256 string")
    assert rules(gate.allowlist_findings(a, shipped)) == ["allowed_file_missing", "allowed_twice", "file_changed", "file_not_allowed", "path_outside_media"]
    assert gate.dry_run(gate.flag_findings(ok), gate.scope_findings(ok)).first().verdict == "READY"


def test_catalogues_and_pages(spark):
    works = spark.createDataFrame([("b", "2001-01-01", "x", "c"), ("a", "2001-01-01", "y", "c"), ("z", None, "w", "d")], "title string, date string, work_id string, collection string")
    assert {r.collection: r.titles for r in catalog.by_collection(works).collect()} == {"c": ["a", "b"], "d": ["z"]}
    links = catalog.translations_of(works, spark.createDataFrame([("t1", "x", ["y", "x"]), ("t2", "y", None), ("t3", None, None)], "translation_id string, work_id string, related_work_ids array<string>"))
    assert {r.work_id: r.translation_ids for r in links.collect()} == {"x": ["t1"], "y": ["t1", "t2"]}
    crumbs = json.loads(one(spark, publish.breadcrumb(F.array(F.struct(F.lit("A").alias("name"), F.lit("/a").alias("path"))), "https://e"), v=""))
    assert crumbs["itemListElement"] == [{"@type": "ListItem", "position": 1, "name": "A", "item": "https://e/a"}]
    xml = publish.sitemap(spark.createDataFrame([("https://e/b",), ("https://e/a?x&y",)], "url string")).first().xml
    assert xml.index("a?x&amp;y") < xml.index("https://e/b")
    page = one(spark, publish.page(F.lit("A<b"), F.lit("<p>x</p>"), F.lit("../"), F.lit("https://e/a"), F.lit("d")), v="")
    assert page.count("<h1>") == 1 and "A&lt;b" in page and "<p>x</p>" in page


def test_readers_and_sinks(spark, tmp_path):
    w, a, r = readers._W[1:-1], readers._A[1:-1], readers._R[1:-1]
    doc = f'<w:document xmlns:w="{w}" xmlns:a="{a}" xmlns:r="{r}"><w:body><w:p><w:r><w:t>before</w:t></w:r></w:p><w:p/><w:p><a:blip r:embed="i1"/><a:blip r:embed="i1"/></w:p><w:p><w:r><w:t>after</w:t></w:r></w:p></w:body></w:document>'
    rels = '<Relationships xmlns="x"><Relationship Id="i1" Target="media/image1.png"/></Relationships>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, body in (("word/document.xml", doc), ("word/_rels/document.xml.rels", rels), ("word/media/image1.png", "bytes")):
            z.writestr(name, body)
    fb2 = '<FictionBook xmlns:l="x"><body><section><title><p>T</p></title><p>one & two</p><section><p>in</p><image l:href="#i"/></section><p>out</p></section></body><binary id="i">YWJj</binary></FictionBook>'
    files = spark.createDataFrame([("a.docx", buffer.getvalue()), ("b.docx", b"no zip")], "path string, content binary")
    assert [(m.member, bytes(m.data)) for m in readers.zip_members(files).collect()] == [("image1.png", b"bytes")]
    near = readers.image_neighbours(readers.docx_paragraphs(files)).collect()
    assert [(n.image, n.previous, n.following) for n in near] == [("image1.png", "before", "after")]
    events = readers.fb2_events(spark.createDataFrame([("c.fb2", fb2.encode())], "path string, content binary"))
    assert readers.fb2_markdown(events).first().text == "## T\n\none & two\n\nin\n\nout"
    image = readers.fb2_images(events).first()
    assert (image.before, image.behind, bytes(image.bytes)) == ("in", "out", b"abc")
    heads = [("p.png", b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 3, 4)), ("g.gif", b"GIF89a" + struct.pack("<HH", 5, 6)), ("j.jpg", b"\xff\xd8\xff\xe0\0\4ab\xff\xc0\0\x11\x08" + struct.pack(">HH", 8, 7)), ("x", b"?")]
    assert {s.path: (s.width, s.height) for s in readers.image_sizes(spark.createDataFrame(heads, "path string, content binary")).collect()} == {"p.png": (3, 4), "g.gif": (5, 6), "j.jpg": (7, 8), "x": (None, None)}
    assert readers.json_lines(spark, str(tmp_path / "none"), "a int").count() == 0

    out = str(tmp_path / "site")
    sinks.pages(spark.createDataFrame([("x/a.md", "A"), ("b.md", "B")], "path string, text string"), out)
    tree = {f.path: f.text for f in readers.markdown(spark, out).collect()}
    assert tree == {"x/a.md": "A", "b.md": "B"}
    listed = {m.path: m.bytes for m in audit.manifest(readers.files(spark, out)).collect()}
    assert listed == {"x/a.md": 1, "b.md": 1}
    for bad in (out, str(tmp_path), out + "/x"):
        with pytest.raises(ValueError):
            sinks.check_output(bad, [out])
    with pytest.raises(Exception, match="leads out"):
        sinks.pages(spark.createDataFrame([("../evil", "A")], "path string, text string"), out)
    rows = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    sinks.json_lines(rows, str(tmp_path / "j"))
    assert readers.json_lines(spark, str(tmp_path / "j"), "a int, b string").count() == 2
    for _ in range(2):
        ingest.json_lines(spark, str(tmp_path / "j"), "a int, b string", str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    lines = tmp_path / "l.jsonl"
    lines.write_text('{"volume": 1, "name": "a", "sha256": "x", "decision": "approved"}\n\n{"volume": 1, "name": "a", "sha256": "y", "decision": "approved"}\n{"volume": 1, "name": "b", "sha256": "z", "decision": "rejected"}\n')
    allowed = readers.allowlist(readers.numbered_lines(spark, str(lines), "volume int, name string, sha256 string, decision string")).collect()
    assert [tuple(r) for r in allowed] == [(1, "a", "y")]


def test_editorial_rules_of_good_records(spark):
    topics = spark.createDataFrame([("topic-a", "A", ("title_terms", ["a"]), 1, "published")], "topic_id string, label string, membership_rule struct<type:string,terms:array<string>>, membership_rule_version int, publication_state string")
    concept = spark.createDataFrame([("cp-a", "a", "corpus_term", [("s", "title", None)], "reviewed", "editor", "2020", "published", ["topic-a"], ["cp-a"])], "concept_id string, canonical_term string, definition_scope string, evidence array<struct<section_id:string,kind:string,term:string>>, review_state string, review_role string, reviewed_at string, publication_state string, related_topic_ids array<string>, related_concept_ids array<string>")
    citations = spark.createDataFrame([("ct-1", "w", "s", "a", "en")], "citation_target_id string, work_id string, section_id string, anchor string, language string")
    variants = spark.createDataFrame([
        ("lv-a-en", "a", "en", "A", "canonical", "reviewed", None, "lv-a-en"), ("lv-a-de", "a", "de", "A", "confirmed", "reviewed", "lv-a-en", "lv-a-en"),
    ], "variant_id string, entity_id string, language string, canonical_name string, translation_status string, review_status string, source_variant_id string, canonical_variant_id string")
    assert rules(semantic.record_errors(topics, concept, citations, variants)) == []
