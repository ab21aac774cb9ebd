"""The registry of figures from files built here."""

import base64
import hashlib
import struct

from pyspark.sql import functions as F

from scriptorium.operators import figures

from .test_forms import compound, zipped

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
LONG = "A paragraph of the source that is long enough to be found again in the text"
OTHER = "Another paragraph, before the picture of nothing, long enough to be found as well"


def png(seed, width=300, height=200):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", width, height) + hashlib.sha256(seed.encode()).digest() * 80


def docx(paragraphs, media):
    """paragraphs: (words, image or None)."""
    names = list(media)
    body = "".join(f'<w:p><w:r><w:t>{t}</w:t>' + (f'<a:blip r:embed="r{names.index(m)}"/>' if m else "") + "</w:r></w:p>" for t, m in paragraphs)
    rels = "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="media/{n}"/>' for i, n in enumerate(names)) + "</Relationships>"
    files = {"word/document.xml": f"<w:document {W}><w:body>{body}</w:body></w:document>", "word/_rels/document.xml.rels": rels}
    return zipped({**files, **{f"word/media/{n}": d for n, d in media.items()}})


def fb2(items, binaries):
    """items: a text, or #name of an image."""
    body = "".join(f'<image l:href="{x}"/>' if x.startswith("#") else f"<p>{x}</p>" for x in items)
    data = "".join(f'<binary id="{n}">{base64.b64encode(d).decode()}</binary>' for n, d in binaries.items())
    return f'<FictionBook xmlns:l="http://www.w3.org/1999/xlink"><body><section>{body}</section></body>{data}</FictionBook>'.encode()


def lines(spark, files):
    rows = [(w, f"{f}#", f, i, t) for (w, f), text in files.items() for i, t in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "work_id string, section_id string, file string, line_no int, line string")


def scene(spark):
    shared, scheme = png("shared"), b"vector bytes" * 300
    files = [
        ("docx/b1.docx", docx([(LONG, None), ("Рис. 1. Схема всего", "image1.emf"), (OTHER, "image2.png"), ("x", "image3.png"), (LONG + " twice", "image4.png")],
                              {"image1.emf": scheme, "image2.png": png("free"), "image3.png": shared, "image4.png": png("lone")})),
        ("site_files/c.fb2", fb2(["First words of the book", "#p.png", "Second words", "#gone.png", "Not in the text", "#v.emf", "Third words"], {"p.png": shared, "v.emf": scheme})),
        ("junk.docx", b"no archive"),
    ]
    works = [
        ("book-b", "docx/b1.docx", "docx", "b.doc", "sha-b", "https://e.org/b"), ("book-c", "site_files/c.fb2", "fb2", "c.fb2", "sha-c", None), ("book-d", "docx/none.docx", "docx", "d.doc", "sha-d", None), ("book-e", None, None, "e", None, None),
    ]
    text = {
        ("book-b", "b/1.md"): "# Title\n\nРис. 1. Схема всего\n![](media/image1.png)\n\n![x](media/absent.png) ![far](https://e.org/a.png)\n" + LONG,
        ("book-b", "b/2.md"): f"{OTHER}\n<img alt='1' src=\"media/image1.png\">\n![](media/image3.png)",
        ("book-c", "c/1.md"): "First words of the *book*\nmore\nThird words\nРис. 9",
        ("book-d", "d/1.md"): "![](media/lost.png)",
        ("vol-1", "v/1.md"): "one\n![](assets/a.png)\n![](assets/zzz.png)",
    }
    objects = [
        ("vol-1", "preview", "a.png", png("a preview")), ("vol-1", "original", "a.emf", scheme), ("vol-1", "preview", "alone.png", png("alone")), ("vol-1", "crop", "page-7.png", png("crop")), ("vol-1", "preview", "again.png", shared),
    ]
    ole = [("vol-1", "ole/o1.bin", compound({"\x03EPRINT": b"\x01" * 600})), ("vol-1", "ole/o2.bin", b"broken")]
    return figures.figure_registry(
        spark.createDataFrame(works, "work_id string, source_path string, source_kind string, source_name string, source_sha256 string, url string"),
        spark.createDataFrame(files, "path string, content binary"),
        lines(spark, text),
        spark.createDataFrame(objects, "work_id string, folder string, name string, content binary"),
        spark.createDataFrame(ole, "work_id string, path string, content binary"),
        spark.createDataFrame([("vol-1", "a.png", 12), ("vol-1", "a.png", 11)], "work_id string, image string, page int"),
    )


def test_registry_of_all_feeders(spark):
    out = scene(spark)
    got = {r.figure_id: r for r in out.collect()}
    assert len(got) == out.count()
    kinds = {k: (r.source_kind, r.publication_status, r.duplicate_of) for k, r in got.items()}
    assert kinds == {
        "vol-1--a": ("docx_embedded_preview", "published", None),
        "vol-1--alone": ("docx_embedded_preview", "metadata_only_rights", None),
        "vol-1--again": ("docx_embedded_preview", "metadata_only_rights", None),
        "vol-1--page-7": ("pdf_page_crop", "metadata_only_rights", None),
        "vol-1--zzz": ("missing_source", "metadata_only_source", None),
        "vol-1--o1": ("ole_object", "metadata_only_source", None),
        "vol-1--o2": ("ole_object", "technical_failure", None),
        "book-b--image1": ("docx_embedded", "duplicate", "vol-1--a"),
        "book-b--absent": ("unresolved_reference", "metadata_only_source", None),
        "book-b--image3": ("docx_embedded", "duplicate", "vol-1--again"),
        "book-b--unbound-image2": ("docx_embedded_unbound", "published", None),
        "book-b--unbound-image4": ("docx_embedded_unbound", "metadata_only_rights", None),
        "book-d--lost": ("missing_source", "metadata_only_source", None),
        "book-c--fb2-001-p": ("fb2_embedded", "duplicate", "vol-1--again"),
        "book-c--fb2-003-gone": ("fb2_embedded", "metadata_only_source", None),
        "book-c--fb2-005-v": ("fb2_embedded", "duplicate", "vol-1--a"),
    }
    bound = got["book-b--image1"]
    assert (bound.section_id, bound.ref_count, bound.ref_sites, bound.original_filename, bound.media_file) == ("b/1.md#", 2, ["b/1.md", "b/2.md"], "image1.emf", "image1.png")
    assert bound.caption == "Рис. 1. Схема всего" and bound.figure_label == "Рис. 1." and bound.media_type == "scheme" and bound.rights_status == "rights_review_required"
    assert bound.containing_source == "b.doc" and bound.source_file == "https://e.org/b" and bound.asset_of == "vol-1--a" and bound.duplicate_blocked_by is None
    assert got["book-b--image3"].duplicate_blocked_by == "metadata_only_rights" and got["book-b--image3"].asset_of is None
    free = got["book-b--unbound-image2"]
    assert (free.anchor_file, free.anchor_line, free.anchor_mode, free.anchor_confidence, free.section_id) == ("b/2.md", 0, "after", "anchor_exact", "b/2.md#")
    assert free.figure_label == "Рис. 1." and free.media_type == "other" and free.conversion == "verbatim_copy"
    assert got["vol-1--a"].source_page == 11 and got["vol-1--a"].conversion == "preview of .emf" and got["vol-1--a"].source_sha256 == hashlib.sha256(b"vector bytes" * 300).hexdigest()
    one, three = got["book-c--fb2-001-p"], got["book-c--fb2-005-v"]
    assert (one.anchor_line, one.anchor_mode, one.referenced_in_text) == (0, "after", True)
    assert (three.anchor_line, three.anchor_mode, three.figure_label) == (2, "before", "Рис. 9")
    assert one.anchor_sha256 == hashlib.sha256("First words of the book".encode()).hexdigest()
    assert got["book-c--fb2-003-gone"].notes == "the source holds no such object" and got["book-c--fb2-003-gone"].anchor_line is None


def test_no_sources_at_all(spark):
    works = spark.createDataFrame([], "work_id string, source_path string, source_kind string, source_name string, source_sha256 string, url string")
    files = spark.createDataFrame([], "path string, content binary")
    assert figures.figure_registry(works, files, lines(spark, {})).count() == 0


def test_every_level_of_source_resolution(spark):
    works = spark.createDataFrame([
        ("by-log", "s1", "site:x.fb2"), ("made", "s2", None), ("as-found", "s3", None), ("mended", "s9", "site:m.doc"), ("named", None, "site:n.FB2"), ("lost", "s8", "site:q.doc"), ("other", None, "n.FB2"), ("last-line", "s4", None),
    ], "work_id string, sha256_source string, source_name string")
    converted = spark.createDataFrame([(1, "s1", "w1"), (1, "s4", "old"), (2, "s4", "new")], "line_no int, sha256 string, id string")
    classified = spark.createDataFrame([(1, "s1", "z.doc", "doc"), (1, "s2", "a.b.doc", "doc"), (1, "s3", "c.fb2", "fb2")], "line_no int, sha256 string, file string, ext string")
    files = spark.createDataFrame([("site_docx/a.b.docx",), ("site_docx/z.docx",), ("repaired/m.docx",), ("site_files/m.doc",), ("site_files/n.FB2",), ("site_files/n.FB2",)], "path string")
    got = {r.work_id: (r.level, r.source_kind, r.source_path) for r in figures.resolve_sources(works, converted, classified, files).collect()}
    assert got == {
        "by-log": ("conversion log", "docx", "docx/w1.docx"), "made": ("classified log, converted", "docx", "site_docx/a.b.docx"), "as-found": ("classified log, as found", "fb2", "site_files/c.fb2"),
        "mended": ("name, repaired", "docx", "repaired/m.docx"), "named": ("name, as found", "fb2", "site_files/n.FB2"), "lost": (None, None, None), "other": (None, None, None), "last-line": ("conversion log", "docx", "docx/new.docx"),
    }


def test_election_of_many_equal_objects(spark):
    """A hot object: one canonical record, whatever the partitions."""
    rows = spark.range(3000).select(
        F.concat(F.lit("f"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("figure_id"), F.lit("w").alias("work_id"), F.lit("same").alias("source_sha256"), F.lit("published").alias("publication_status"),
        F.lit(1).alias("seat_feeder"), F.lit(0).alias("seat_phase"), (3000 - F.col("id")).alias("seat_place"), F.lit("n").alias("original_filename"), F.lit(True).alias("may_repeat"),
    )
    got = figures.elect(figures.shaped(rows.repartition(7))).groupBy("publication_status", "duplicate_of", "asset_of").count().collect()
    assert sorted((r.publication_status, r.duplicate_of, r["count"]) for r in got) == [("duplicate", "f02999", 2999), ("published", None, 1)]
