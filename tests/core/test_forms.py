"""Chunks against a plain loop, office files, compound files, the leak scanner and the publishing helpers."""

import base64
import hashlib
import io
import random
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import audit, publish, registry, search, sections
from scriptorium.sources import office, readers


def cuts(text, limit, separator):
    """Where chunks end: a window of the text at a time, every place in it tried from the end."""
    least, out, begun = max(1200, limit // 3), [], 0
    while len(text) - begun > limit:
        places = [e for e in range(begun + least + len(separator), begun + limit + 1) if text[e - len(separator) : e] == separator]
        begun = places[-1] if places else begun + limit
        out.append(begun)
    return out + [len(text)] * (len(text) > begun)


@pytest.mark.parametrize("limit,separator", [(3200, "\n\n"), (1300, "\n"), (1202, "\n\n"), (900, "\n"), (2000, ".*")])
def test_chunks_equal_a_plain_loop(spark, limit, separator):
    rng = random.Random(limit)
    texts = [None, "", "x", separator, separator * 3000, "y" * limit, "y" * (limit + 1), "z" * 10_000]
    for _ in range(120):
        parts = ["é" * rng.choice([1, 30, 300, 1199, 1200, 1201, limit - 2, limit, 5000]) + rng.choice(["", separator, separator * 2, separator[:1]]) for _ in range(rng.randrange(12))]
        texts.append("".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [(c.start, c.stop) for c in r.c] for r in df.select("doc_id", sections.chunk_ranges(F.col("text"), limit, separator).alias("c")).collect()}
    for i, t in enumerate(texts):
        ends = cuts(t or "", limit, separator)
        assert got[i] == list(zip([0, *ends], ends)), i
    whole = sections.rejoined(sections.chunks(df, limit=limit, separator=separator), "doc_id", "chunk_no", "text").collect()
    assert all(r.whole == texts[r.doc_id] for r in whole)


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)
    return buffer.getvalue()


def test_office_files_as_markdown(spark):
    w = readers._W[1:-1]
    docx = f'<w:document xmlns:w="{w}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>one</w:t><w:tab/><w:t>two</w:t><w:footnoteReference w:id="3"/></w:r></w:p></w:body></w:document>'
    notes = f'<w:footnotes xmlns:w="{w}"><w:footnote w:type="separator" w:id="0"><w:p><w:r><w:t>-</w:t></w:r></w:p></w:footnote><w:footnote w:id="3"><w:p><w:r><w:t>a note</w:t></w:r></w:p></w:footnote></w:footnotes>'
    odt = '<o:d xmlns:o="o" xmlns:t="t"><t:h t:outline-level="3">Top</t:h><t:p>a<t:s t:c="2"/>b <t:span>c</t:span><t:line-break/>d</t:p><t:p/></o:d>'
    container = '<c><rootfiles><rootfile full-path="e/p.opf"/></rootfiles></c>'
    package = '<package><manifest><item id="b" href="b.html"/><item id="a" href="../a.html"/></manifest><spine><itemref idref="a"/><itemref idref="b"/><itemref idref="gone"/></spine></package>'
    files = {
        "d.docx": ("docx", zipped({"word/document.xml": docx, "word/footnotes.xml": notes})), "o.odt": ("odt", zipped({"content.xml": odt})), "bad.docx": ("docx", b"no archive"), "broken.odt": ("odt", zipped({"content.xml": "<a>"})),
        "e.epub": ("epub", zipped({"META-INF/container.xml": container, "e/p.opf": package, "a.html": "<h1>First</h1><p>text</p>", "e/b.html": "<p>second</p>"})), "x.doc": ("doc", b"?"), "t.txt": ("txt", "plain é".encode()),
    }
    df = spark.createDataFrame([(k, f, c) for k, (f, c) in files.items()], "path string, format string, content binary")
    got = {r.path: r.text for r in readers.convert(df).collect()}
    assert got == {"d.docx": "## Head\n\none\ttwo[^3]\n\n[^3]: a note", "o.odt": "### Top\n\na  b c\nd", "bad.docx": None, "broken.odt": None, "e.epub": "# First\n\ntext\n\nsecond", "x.doc": None, "t.txt": "plain é"}


def compound(streams):
    """A compound file of one FAT sector, all streams in sectors of their own."""
    free, end = 0xFFFFFFFF, 0xFFFFFFFE
    names = list(streams)
    bodies = [s + b"\0" * (-len(s) % 512) for s in streams.values()]
    dirs = -(-(len(names) + 1) // 4)
    fat, at = [0xFFFFFFFD], 1
    for i in range(dirs):
        fat.append(at + 1 if i + 1 < dirs else end)
        at += 1
    starts = []
    for b in bodies:
        starts.append(at)
        n = len(b) // 512
        fat += [at + i + 1 for i in range(n - 1)] + [end]
        at += n
    entry = lambda name, kind, start, size: (name + "\0").encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBB", 2 * len(name) + 2, kind, 1) + b"\xff" * 12 + b"\0" * 36 + struct.pack("<IQ", start, size)
    table = entry("Root Entry", 5, end, 0) + b"".join(entry(n, 2, a, len(s)) for n, a, s in zip(names, starts, streams.values()))
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 10 + struct.pack("<IIIIIIIII", 1, 1, 0, 0, end, 0, end, 0, 0) + struct.pack("<108I", *[free] * 108)
    return head + struct.pack("<128I", *(fat + [free] * (128 - len(fat)))) + table.ljust(512 * dirs, b"\0") + b"".join(bodies)


def test_compound_files(spark):
    picture = b"EMF" * 2000
    files = {"p.bin": compound({"\x03EPRINT": picture, "Package": b"z" * 5000}), "w.bin": compound({"WordDocument": b"w" * 4096}), "o.bin": compound({"Other": b"o" * 4100}), "x.bin": b"nothing", "cut.bin": compound({"Other": b"o" * 4100})[:1000]}
    assert office.Compound(files["p.bin"]).streams() == {"\x03EPRINT": picture, "Package": b"z" * 5000}
    got = {r.path: r for r in office.ole_objects(spark.createDataFrame(list(files.items()), "path string, content binary")).collect()}
    assert {k: (r.kind, r.publication_status) for k, r in got.items()} == {"p.bin": ("preview", "metadata_only_source"), "w.bin": ("document", "metadata_only_source"), "o.bin": ("other", "technical_failure"), "x.bin": ("unreadable", "technical_failure"), "cut.bin": ("unreadable", "technical_failure")}
    assert got["p.bin"].source_sha256 == hashlib.sha256(picture).hexdigest() and got["w.bin"].source_sha256 == hashlib.sha256(files["w.bin"]).hexdigest()


def scanned(spark, files, **more):
    df = spark.createDataFrame(list(files.items()), "path string, content binary")
    return {(r.severity, r.rule, r.entity_key) for r in audit.scan_files(df, **more).collect()}


def test_scanner_branches(spark):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + b"\0\0\0\0"
    png = lambda *chunks: b"\x89PNG\r\n\x1a\n" + b"".join(chunks)
    mail = b"write to someone@example.org now, and then wait for it"
    files = {
        "text.png": png(chunk(b"tEXt", b"k\0" + mail)), "itext.png": png(chunk(b"iTXt", b"k\0\1\0en\0k\0" + zlib.compress(mail))), "behind.png": png(chunk(b"IEND", b""), chunk(b"zTXt", b"k\0\0" + zlib.compress(mail))),
        "c.jpg": b"\xff\xd8\xff\xe0\0\4ab\xff\xfe" + struct.pack(">H", len(mail) + 2) + mail + b"\xff\xd9", "b.md": b"x " + base64.b64encode(mail + b"!!"), "odd.md": b"x " + base64.b64encode(mail + b"!!")[:-1], "nul.md": b"x " + base64.b64encode(b"\0\0" + mail),
        "bom.txt": mail.decode().encode("utf-16"), "case.md": b"the OPERATOR was here", "noise.dat": b"ab@AB.CD" * 3, "work.html": b"see /mnt/data/x", "js.md": b"JavaScript: x", "ok.html": b'<script src="assets/reader.js"></script><script type="application/ld+json">',
        "late.txt": b"x " * 3_000_000 + mail, "free.md": b"a@users.noreply.github.com", "path.md": rb"C:\Users\me", "id.html": b"?id=" + b"a" * 20, "drive.csv": b"docs.google.com/drive/x",
    }
    e = "e-mail address"
    want = {("block", e, n) for n in ("text.png", "itext.png", "c.jpg", "b.md", "bom.txt", "late.txt")} | {
        ("block", "literal operator", "case.md"), ("block", "internal workspace path", "work.html"), ("block", "javascript: URL in output", "js.md"), ("block", "personal path/username", "path.md"), ("block", "opaque external file id", "id.html"), ("block", "personal Drive link", "drive.csv"),
    }
    assert scanned(spark, files, literals=["operator"]) == want
    assert scanned(spark, {"js.md": files["js.md"], "work.html": files["work.html"]}, site=False) == set()
    bomb = png(chunk(b"zTXt", b"k\0\0" + zlib.compress(b"a" * 5_000_000)))
    assert scanned(spark, {"big.png": bomb}) == {("note", "not_scanned_whole", "big.png")}


def test_anchor_rules(spark):
    long, twice, then = "a long enough line of words to be found exactly here", "twice said words that are long enough", "what follows is only said in one of both files"
    lines = spark.createDataFrame([("w", "a.md", 1, long), ("w", "a.md", 2, twice), ("w", "b.md", 1, twice), ("w", "b.md", 5, then), ("w", "b.md", 2, "part of a much longer sentence in the book, yes")], "work_id string, file string, line_no int, norm string")
    places = [
        ("exact", long, "", ""), ("dirty", "center635 left12 " + long, "", ""), ("on", twice, "", then), ("both", twice, "", ""), ("held", "part of a much longer sentence", "", ""), ("before", "short", long, ""),
        ("after", None, None, long), ("none", "nothing like this is to be found in them", "", ""), ("short", "short", "", ""), ("holder", "And here is part of a much longer sentence in the book, yes indeed.", "", ""),
    ]
    df = spark.createDataFrame([(i, "w", *rest) for i, *rest in places], "place_id string, work_id string, paragraph string, previous string, next string")
    got = {r.place_id: (r.confidence, r.file, r.line_no, r["mode"]) for r in registry.recover_anchors(df, lines).collect()}
    assert got == {
        "exact": ("anchor_exact", "a.md", 1, "after"), "dirty": ("anchor_exact", "a.md", 1, "after"), "on": ("anchor_strong", "b.md", 1, "after"), "both": ("anchor_probable", None, None, None), "held": ("anchor_strong", "b.md", 2, "after"),
        "before": ("anchor_exact", "a.md", 1, "after"), "after": ("anchor_exact", "a.md", 1, "before"), "none": ("unbound_confirmed", None, None, None), "short": ("unbound_confirmed", None, None, None), "holder": ("anchor_exact", "b.md", 2, "after"),
    }


def test_anchors_of_many_equal_places_and_long_lines(spark):
    same, book = "one sentence that stands in every file of the work", " ".join(f"w{i}x" for i in range(3000))
    lines = [("w", f"{i}.md", 0, same) for i in range(300)] + [("w", "x.md", 0, book), ("w", "x.md", 1, "w77x w78x w79x w80x w81x w82x w83x"), ("v", "y.md", 0, same)]
    places = [(f"p{i}", "w", same, "", "") for i in range(300)] + [("q", "w", book[5000:5060], "", ""), ("r", "v", same, "", ""), ("s", "w", "z" + book + "z", "", ""), ("t", None, same, "", "")]
    found = registry.recover_anchors(spark.createDataFrame(places, "place_id string, work_id string, paragraph string, previous string, next string"), spark.createDataFrame(lines, "work_id string, file string, line_no int, norm string"))
    got = {r.place_id: (r.confidence, r.file) for r in found.collect()}
    assert got == {f"p{i}": ("anchor_probable", None) for i in range(300)} | {"q": ("anchor_exact", "x.md"), "r": ("anchor_exact", "y.md"), "s": ("anchor_exact", "x.md"), "t": ("unbound_confirmed", None)}
    # no join lays out all pairs of equal places and lines, and lines are not dealt out once for each of their words
    plan = found._jdf.queryExecution().toString()
    assert "explode(array_distinct(split(norm" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_contexts_by_words(spark):
    bodies = spark.createDataFrame([(1, "one two three four"), (2, "xone two threey"), (3, "solo\nword here")], "section_id int, body string")
    probes = spark.createDataFrame([("a", 0, "two three four"), ("b", 0, "one two three"), ("c", 0, "solo"), ("d", 0, "e two t"), ("d", 1, "o\nwo"), ("e", 0, ""), ("f", 0, "no such thing")], "item_id string, rank int, phrase string")
    assert {r.item_id: r.section_id for r in registry.unique_context(probes, bodies).collect()} == {"a": 1, "c": 3, "d": 3}


def test_publishing_helpers(spark):
    assert "Disallow: /\n" in publish.robots("candidate") and publish.robots("public", "https://e.org/").endswith("Sitemap: https://e.org/sitemap.xml\n")
    assert publish.llms_text("T", "note", [("a.html", "b")]) == "# T\n\nnote\n\n- a.html — b\n"
    urls = spark.createDataFrame([("https://e/b",), ("https://e/a&c",), ("https://e/b",)], "url string")
    assert [r.value for r in publish.sitemap_lines(urls).collect()] == ["<url><loc>https://e/a&amp;c</loc></url>", "<url><loc>https://e/b</loc></url>"]
    concepts = spark.createDataFrame([("cp-a", "Alpha", None, "what it is")], "concept_id string, canonical_term string, aliases array<string>, definition string")
    row = search.concept_rows(concepts).first()
    assert (row.title, row.kind, row.text, row.section_id) == ("Alpha", "concept", "what it is", None)
