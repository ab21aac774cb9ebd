"""Readers: JSON lines, file trees, Markdown, and the containers DOCX and FB2, as typed tables."""

from __future__ import annotations

import base64
import io
import re
import struct
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed, markup, text

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_V = "{urn:schemas-microsoft-com:vml}"


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file or folder, blank lines skipped; an empty table if there is none."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def numbered_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As json_lines of one file, with line_no, for rules by which the last line wins."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line_no", "value")).where(F.trim("value") != "")
    return lines.select("line_no", F.from_json("value", schema).alias("r")).select("line_no", "r.*")


def last_by(rows: DataFrame, keys: list[str], order: str = "line_no") -> DataFrame:
    """The last row of each key."""
    others = [c for c in rows.columns if c not in (*keys, order)]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("r")).select(*keys, "r.*")


def allowlist(rows: DataFrame, keys: tuple[str, ...] = ("volume", "name")) -> DataFrame:
    """keys and sha256 of approved rows that carry both, the last for each key."""
    kept = rows.where(F.col("decision") == "approved").where(F.col("sha256").isNotNull())
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    return last_by(kept.select(*keys, "sha256", "line_no"), list(keys))


def works_and_sections(works: DataFrame, excluded: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Works that are not excluded, and their sections in order with tidy titles."""
    kept = works.join(excluded.select("work_id"), "work_id", "left_anti")
    title = text.tidy_title(text.soft_hyphens(F.col("title")))
    return kept.withColumn("title", title), sections.join(kept.select("work_id"), "work_id", "left_semi").withColumn("title", title)


def files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path (below root), bytes and content of every file of a tree."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = re.escape(root.rstrip("/"))
    return rows.select(F.regexp_replace("path", rf"^.*?{base}/", "").alias("path"), F.col("length").alias("bytes"), "content")


def markdown(spark: SparkSession, root: str) -> DataFrame:
    """path and text of every Markdown file of a tree."""
    return files(spark, root, "*.md").select("path", F.decode("content", "UTF-8").alias("text"))


def front_matter(rows: DataFrame, keys: list[str], body: str = "text") -> DataFrame:
    return rows.select("*", *[text.front_matter(F.col(body), k).alias(k) for k in keys])


# containers


def _mapped(rows: DataFrame, schema: str, one: Callable[[str, bytes], Iterator[tuple]]) -> DataFrame:
    """Rows that one() finds in each (path, content)."""
    names = [x.strip().split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                found = [(path, *r) for r in one(path, data or b"")]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), arrow)], names=names)

    kinds = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    arrow = [kinds[x.strip().split()[1]] for x in schema.split(",")]
    return rows.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(run, schema)


def zip_members(rows: DataFrame, prefix: str = "word/media/") -> DataFrame:
    """path, member and data of the members below prefix of every archive; what is no archive has none."""

    def one(_: str, data: bytes) -> Iterator[tuple]:
        if zipfile.is_zipfile(io.BytesIO(data)):
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                for name in sorted(z.namelist()):
                    if name.startswith(prefix) and not name.endswith("/"):
                        yield name[len(prefix) :], z.read(name)

    return _mapped(rows, "path string, member string, data binary", one)


def docx_paragraphs(rows: DataFrame) -> DataFrame:
    """path, part, paragraph_no, image (null for none) and words: one row a paragraph, or one for each different image in it."""

    def one(_: str, data: bytes) -> Iterator[tuple]:
        if not zipfile.is_zipfile(io.BytesIO(data)):
            return
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = set(z.namelist())
            for part in sorted(n for n in names if re.fullmatch(r"word/(document|header\d*|footer\d*|footnotes|endnotes)\.xml", n)):
                rels = part.replace("word/", "word/_rels/") + ".rels"
                targets = {r.get("Id"): r.get("Target", "").rpartition("/")[2] for r in ET.fromstring(z.read(rels))} if rels in names else {}
                for i, p in enumerate(ET.fromstring(z.read(part)).iter(f"{_W}p")):
                    words = "".join(t.text or "" for t in p.iter(f"{_W}t"))
                    ids = [b.get(f"{_R}embed") for b in p.iter(f"{_A}blip")] + [b.get(f"{_R}id") for b in p.iter(f"{_V}imagedata")]
                    for image in list(dict.fromkeys(targets.get(x) for x in ids if x in targets)) or [None]:
                        yield part, i, image, words

    return _mapped(rows, "path string, part string, paragraph_no int, image string, words string", one)


def image_neighbours(paragraphs: DataFrame) -> DataFrame:
    """Paragraphs with images and the nearest paragraphs before and behind that have words."""
    w = Window.partitionBy("path", "part").orderBy("paragraph_no")
    words = F.nullif(F.trim("words"), F.lit(""))
    rows = paragraphs.withColumn("previous", F.last(words, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, -1))).withColumn("following", F.first(words, ignorenulls=True).over(w.rangeBetween(1, Window.unboundedFollowing)))
    return rows.where("image IS NOT NULL")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _fb2_root(data: bytes) -> ET.Element | None:
    """The tree of an FB2 file; broken ampersands and control characters are mended before giving up."""
    for source in (data, re.sub(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]", b"", re.sub(rb"&(?!#?\w+;)", b"&amp;", data))):
        try:
            return ET.fromstring(source)
        except ET.ParseError:
            continue
    return None


def fb2_events(rows: DataFrame) -> DataFrame:
    """path, pos, kind (title, p, image), section and value in reading order, and the embedded binaries (kind binary, value the name, data)."""

    def one(_: str, data: bytes) -> Iterator[tuple]:
        root = _fb2_root(data)
        if root is None:
            return
        pos = section = 0

        def walk(node, title: bool):
            nonlocal section
            for child in node:
                tag = _local(child.tag)
                if tag == "section":
                    section += 1
                    yield from walk(child, False)
                elif tag == "title":
                    yield "title", " ".join(" ".join(child.itertext()).split()), None
                elif tag == "image":
                    yield "image", next((v.lstrip("#") for k, v in child.attrib.items() if _local(k) == "href"), ""), None
                elif tag in ("p", "v", "subtitle", "text-author"):
                    yield "p", " ".join("".join(child.itertext()).split()), None
                    yield from ((k, v, d) for k, v, d in walk(child, title) if k == "image")
                else:
                    yield from walk(child, title)

        for node in root:
            if _local(node.tag) == "body":
                for kind, value, d in walk(node, False):
                    yield pos, kind, section, value, d
                    pos += 1
            elif _local(node.tag) == "binary":
                try:
                    payload = base64.b64decode("".join((node.text or "").split()))
                except ValueError:
                    payload = b""
                yield pos, "binary", section, node.get("id", ""), payload
                pos += 1

    return _mapped(rows, "path string, pos int, kind string, section int, value string, data binary", one)


def fb2_images(events: DataFrame) -> DataFrame:
    """Images with the last text before and the next behind them, and their bytes."""
    w = Window.partitionBy("path").orderBy("pos")
    words = F.when(F.col("kind").isin("p", "title"), F.nullif(F.col("value"), F.lit("")))
    flow = events.where("kind <> 'binary'").withColumn("before", F.last(words, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("behind", F.first(words, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    data = events.where("kind = 'binary'").select("path", "value", F.col("data").alias("bytes"))
    return flow.where("kind = 'image'").drop("data").join(data, ["path", "value"], "left").select("path", "pos", "section", F.col("value").alias("image"), "before", "behind", "bytes")


def fb2_markdown(events: DataFrame) -> DataFrame:
    """path and Markdown of the text: titles as headings, paragraphs apart; every section once."""
    line = F.when(F.col("kind") == "title", F.concat(F.lit("## "), "value")).otherwise(F.col("value"))
    rows = events.where("kind IN ('title', 'p') AND value <> ''").select("path", "pos", line.alias("line"))
    return rows.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n\n").alias("text"))


def image_sizes(rows: DataFrame) -> DataFrame:
    """path, width and height of PNG, GIF, BMP and JPEG files; null for others."""

    def one(_: str, b: bytes) -> Iterator[tuple]:
        if b.startswith(b"\x89PNG") and len(b) >= 24:
            yield struct.unpack(">II", b[16:24])
        elif b[:6] in (b"GIF87a", b"GIF89a") and len(b) >= 10:
            yield struct.unpack("<HH", b[6:10])
        elif b.startswith(b"BM") and len(b) >= 26:
            w, h = struct.unpack("<ii", b[18:26])
            yield w, abs(h)
        elif b.startswith(b"\xff\xd8"):
            at = 2
            while at + 9 <= len(b) and b[at] == 0xFF:
                if b[at + 1] in (*range(0xC0, 0xC4), *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                    h, w = struct.unpack(">HH", b[at + 5 : at + 9])
                    yield w, h
                    return
                at += 2 + struct.unpack(">H", b[at + 2 : at + 4])[0]
            yield None, None
        else:
            yield None, None

    return _mapped(rows, "path string, width int, height int", one)


def pdf_pages(rows: DataFrame, extracted: str = "text") -> DataFrame:
    """path, text and is_usable of text layers that an external tool extracted: pages apart, line ends bare, enough word characters."""
    tidy = F.regexp_replace(F.regexp_replace(F.regexp_replace(extracted, "\f", "\n\n"), r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n")
    return rows.select("path", F.trim(tidy).alias("text")).withColumn("is_usable", text.word_chars(F.col("text")) >= fixed.PDF_LEAST_WORD_CHARS)


def convert(rows: DataFrame, external: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """path and Markdown text of sources (path, format, content), by format; other formats (doc, pdf) go to external, or have null text."""
    from . import office

    fb2 = fb2_markdown(fb2_events(rows.where("format = 'fb2'")))
    html = rows.where("format = 'html'").select("path", markup.html_to_markdown(F.decode(F.col("content").cast("binary"), "UTF-8")).alias("text"))
    plain = rows.where("format IN ('md', 'txt')").select("path", F.decode(F.col("content").cast("binary"), "UTF-8").alias("text"))
    packed = office.markdown(rows.where("format IN ('docx', 'odt', 'epub')"))
    rest = rows.where("format NOT IN ('fb2', 'html', 'md', 'txt', 'docx', 'odt', 'epub')")
    other = external(rest) if external else rest.select("path", F.lit(None).cast("string").alias("text"))
    return fb2.unionByName(html).unionByName(plain).unionByName(packed).unionByName(other)


def fixture(spark: SparkSession, works: int = 6, sections: int = 2) -> DataFrame:
    """Sections of an invented library: work_id, section_id, reading_order, title, text."""
    rows = spark.range(1, works + 1).select(F.col("id").alias("w"), F.explode(F.sequence(F.lit(1), F.lit(sections))).alias("s"))
    name = F.concat(F.lit("Section "), F.col("w").cast("string"), F.lit("."), F.col("s").cast("string"))
    return rows.select(F.concat(F.lit("work-"), F.col("w").cast("string")).alias("work_id"), F.concat_ws("-", F.lit("s"), F.col("w").cast("string"), F.col("s").cast("string")).alias("section_id"), F.col("s").alias("reading_order"), name.alias("title"), F.concat(F.lit("# "), name, F.lit("\n\nInvented text.\n")).alias("text"))
