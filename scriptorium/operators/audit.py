"""Link audits, manifests, content scans and structural checks. A rule is a DataFrame of severity, rule, entity_key, detail."""

from __future__ import annotations

import base64
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, paths
from .semantic import finding, together


def html_links(pages: DataFrame, key: str, body: str) -> DataFrame:
    """key, pos and target of every href and src."""
    return pages.select(key, F.posexplode(F.regexp_extract_all(body, F.lit(r'(?:href|src)="([^"#]+?)"'), 1)).alias("pos", "target"))


def markdown_links(docs: DataFrame, key: str, body: str) -> DataFrame:
    """key, pos, label and target of links that are no images."""
    pattern = F.lit(fixed.MARKDOWN_LINK)
    return docs.select(key, F.posexplode(F.arrays_zip(F.regexp_extract_all(body, pattern, 1).alias("label"), F.regexp_extract_all(body, pattern, 2).alias("target"))).alias("pos", "z")).select(key, "pos", "z.label", "z.target")


def images(docs: DataFrame, key: str, body: str) -> DataFrame:
    """key, line_no and source of images in either form."""
    rows = docs.select(key, F.posexplode(F.split(body, "\n")).alias("line_no", "line"))
    found = F.concat(F.regexp_extract_all("line", F.lit(fixed.MARKDOWN_IMAGE), 1), F.regexp_extract_all("line", F.lit(fixed.HTML_IMAGE), 1))
    return rows.select(key, "line_no", F.explode(found).alias("source"))


def glued_images(docs: DataFrame, key: str, body: str) -> DataFrame:
    """key, line_no and kind of images with text on their line before or behind them."""
    rows = docs.select(key, F.posexplode(F.split(body, "\n")).alias("line_no", "line"))
    image = r"!\[[^\]]*\]\([^)]*\)"
    kind = F.when(F.col("line").rlike(r"\S.*" + image) & ~F.col("line").rlike("^" + image), "glued_before").when(F.col("line").rlike(image + r".*\S"), "glued_behind")
    return rows.select(key, "line_no", kind.alias("kind")).where("kind IS NOT NULL")


def unresolved(links: DataFrame, files: DataFrame, base: str = "path") -> DataFrame:
    """Links (base, target) to no file (path): neither remote nor found where they lead."""
    local = links.where(~paths.is_remote(F.col("target"))).withColumn("resolved", paths.resolve(F.col(base), F.col("target")))
    known = files.select(F.col("path").alias("_path"))
    return local.join(known, F.col("resolved") == F.col("_path"), "left_anti")


def manifest(files: DataFrame, path: str = "path", content: str = "content", leave_out: list[str] | None = None) -> DataFrame:
    """path, bytes and sha256 of files."""
    rows = files.where(~F.col(path).isin(leave_out)) if leave_out else files
    return rows.select(F.col(path).alias("path"), F.octet_length(content).cast("bigint").alias("bytes"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))


def forbidden_texts(docs: DataFrame, key: str, body: str, site: bool = False, literals: list[str] | None = None) -> DataFrame:
    """key and label of every forbidden pattern or literal (in any case) that a text holds."""
    rules = fixed.FORBIDDEN + (fixed.FORBIDDEN_IN_SITE if site else [])
    quoted = ["(?i)" + re.escape(x) for x in literals or []]
    marks = F.array(*[F.when(F.col(body).rlike(p), F.lit(label)) for label, p in rules], *[F.when(F.col(body).rlike(p), F.lit("literal")) for p in quoted])
    return docs.select(key, F.explode(F.array_distinct(F.filter(marks, lambda m: m.isNotNull()))).alias("label"))


def forbidden_names(files: DataFrame, path: str = "path", declared: list[str] | None = None) -> DataFrame:
    """Findings of file names that must not be shipped, and of PDFs not declared."""
    name = F.substring_index(path, "/", -1)
    undeclared = files.where(F.lower(name).endswith(".pdf") & ~name.isin(declared or [""]))
    return finding(files.where(name.rlike(fixed.FORBIDDEN_NAMES)), "forbidden_name", F.col(path), name).unionByName(finding(undeclared, "undeclared_pdf", F.col(path), name))


def base64_runs(docs: DataFrame, key: str, body: str) -> DataFrame:
    """key, run and decoded (binary, null if it is not valid as it stands) of long base64 runs."""
    rows = docs.select(key, F.explode(F.regexp_extract_all(body, F.lit(fixed.BASE64_RUN), 0)).alias("run"))
    return rows.withColumn("decoded", F.when(F.length("run") % 4 == 0, F.try_to_binary("run", F.lit("base64"))))


def hidden_texts(docs: DataFrame, key: str, body: str, literals: list[str] | None = None) -> DataFrame:
    """key, n_runs, n_decoded (valid, without NUL and with a printable run) and labels of what the base64 runs of texts hide."""
    found = base64_runs(docs, key, body).withColumn("_text", F.decode("decoded", "ISO-8859-1"))
    told = ~F.contains("_text", F.lit("\0")) & F.col("_text").rlike(fixed.PRINTABLE_RUN)
    found = found.withColumn("_text", F.when(told, F.col("_text")))
    rules = [*fixed.FORBIDDEN, *[("literal", "(?i)" + re.escape(x)) for x in literals or []]]
    labels = F.array_compact(F.array(*[F.when(F.col("_text").rlike(p), F.lit(label)) for label, p in rules]))
    return found.groupBy(key).agg(F.count(F.lit(1)).alias("n_runs"), F.count("_text").alias("n_decoded"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(labels)))), ",").alias("labels"))


def decoded_variants(name: str, data: bytes, limit: int = fixed.SCAN_STREAM_BYTES) -> Iterator[tuple[str, bytes, bool]]:
    """(how, bytes, whether more follows) of what hides in a file: metadata of PNG, comments of JPEG, streams of PDF, UTF-16, base64.

    Inflated data stop at limit bytes, or a small file could fill a worker's memory; the third value then tells.
    """

    def inflate(x: bytes) -> tuple[bytes, bool]:
        try:
            run = zlib.decompressobj()
            return run.decompress(x, limit), bool(run.unconsumed_tail)
        except zlib.error:
            return b"", False

    if data.startswith(b"\x89PNG\r\n\x1a\n"):
        at, kind = 8, b""
        while at + 8 <= len(data) and kind != b"IEND":
            size, kind = struct.unpack(">I4s", data[at : at + 8])
            body = data[at + 8 : at + 8 + size]
            at += 12 + size
            head, _, rest = body.partition(b"\0")
            if kind == b"tEXt":
                yield "png text", body, False
            elif kind == b"zTXt" and rest[:1] == b"\0":
                found, more = inflate(rest[1:])
                yield "png text", head + b" " + found, more
            elif kind == b"iTXt" and len(rest) >= 2:
                packed, tail = rest[0], rest[2:].split(b"\0", 2)[-1]
                found, more = inflate(tail) if packed else (tail, False)
                yield "png text", head + b" " + found, more
    elif data.startswith(b"\xff\xd8"):
        for m in re.finditer(rb"\xff\xfe..", data, re.S):
            yield "jpeg comment", data[m.end() : max(data.find(b"\xff", m.end()), m.end() + struct.unpack(">H", m[0][2:])[0] - 2)], False
    elif data.startswith(b"%PDF"):
        for m in re.finditer(rb"stream\r?\n(.*?)endstream", data, re.S):
            found, more = inflate(m[1])
            if found:
                yield "pdf stream", found, more
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        yield "utf-16", data.decode("utf-16", "ignore").encode(), False
    elif len(data) > 16:
        for coding, first in (("utf-16-le", 1), ("utf-16-be", 0)):
            if data[first::2].count(0) * 4 > len(data):
                yield coding, data.decode(coding, "ignore").encode(), False
    for m in re.finditer(fixed.BASE64_RUN.encode(), data):
        try:
            found = base64.b64decode(m[0], validate=True)
        except ValueError:
            continue
        if b"\0" not in found and re.search(fixed.PRINTABLE_RUN.encode(), found):
            yield "base64", found, False


def scan_files(files: DataFrame, literals: list[str] | None = None, declared_pdfs: list[str] | None = None, site: bool = True) -> DataFrame:
    """Findings in files (path, content): forbidden names, forbidden contents of texts and binaries, and of what they hide; site: as rendered pages.

    Texts are scanned whole, as columns; binaries, and what files hide, byte by byte in Arrow batches. A note says where inflating stopped.
    """
    rules = fixed.FORBIDDEN + (fixed.FORBIDDEN_IN_SITE if site else [])
    is_text = F.lower(F.concat(F.lit("."), F.substring_index("path", ".", -1))).isin(fixed.TEXT_EXTENSIONS)
    rows = files.select("path", F.coalesce(F.col("content").cast("binary"), F.lit(b"")).alias("content"))
    texts = rows.where(is_text).select("path", F.decode("content", "ISO-8859-1").alias("text"))  # patterns are of bytes
    plain = forbidden_texts(texts, "path", "text", site).select(F.lit("block").alias("severity"), F.col("label").alias("rule"), F.col("path").alias("entity_key"), F.lit("").alias("detail"))
    for x in literals or []:
        plain = plain.unionByName(finding(texts.where(F.col("text").rlike("(?i)" + re.escape(x.encode().decode("latin-1")))), f"literal {x}", F.col("path"), ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(label, re.compile(p.encode())) for label, p in rules]
        hidden = [(f"literal {x}", re.compile(re.escape(x.encode()), re.I)) for x in literals or []]
        strict = [("e-mail address", re.compile(fixed.EMAIL_IN_BINARY.encode())), *[c for c in compiled if c[0] != "e-mail address"]]
        base = compiled[: len(fixed.FORBIDDEN)]
        for batch in batches:
            out = []
            for path, data, text in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), batch.column("is_text").to_pylist()):
                found = set()
                for piece in re.findall(fixed.PRINTABLE_RUN.encode(), data) if not text else ():
                    found |= {("block", label, "") for label, rx in strict + hidden if rx.search(piece)}
                for how, piece, more in decoded_variants(path, data):
                    found |= {("block", label, f"via {how}") for label, rx in base + hidden if rx.search(piece)}
                    if more:
                        found.add(("note", "not_scanned_whole", f"via {how}"))
                out += [(severity, label, path, via) for severity, label, via in sorted(found)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["severity", "rule", "entity_key", "detail"])

    hidden_in = rows.withColumn("is_text", is_text).mapInArrow(run, "severity string, rule string, entity_key string, detail string")
    return together([plain, hidden_in, forbidden_names(files, "path", declared_pdfs)])


def findings_by_rule(findings: DataFrame, shown: int = 30) -> DataFrame:
    """severity, rule, n (distinct findings) and, as the report shows them, the first of them in order."""
    once = findings.select("severity", "rule", "entity_key", "detail").distinct()
    place = F.row_number().over(Window.partitionBy("severity", "rule").orderBy("entity_key", "detail"))
    listed = F.array_sort(F.collect_list(F.when(F.col("_place") <= shown, F.concat_ws(" ", "entity_key", F.nullif("detail", F.lit(""))))))
    return once.withColumn("_place", place).groupBy("severity", "rule").agg(F.count(F.lit(1)).alias("n"), listed.alias("shown"))


def section_findings(sections: DataFrame, chunks: DataFrame) -> DataFrame:
    """Findings of sections (section_id, text, sha256, reading_order, page, pdf_pages) and chunks (section_id, chunk_no, start_char, end_char, text)."""
    w = Window.partitionBy("section_id").orderBy("chunk_no")
    gaps = chunks.withColumn("_before", F.lag("end_char", 1, 0).over(w)).where("start_char <> _before OR end_char - start_char <> length(text)")
    joined = chunks.groupBy("section_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "text"))), lambda x: x["text"]), "").alias("_whole"))
    orders = sections.groupBy("reading_order").count().where("count > 1")
    return together(
        [
            finding(sections.groupBy("section_id").count().where("count > 1"), "duplicate_section_id", F.col("section_id"), F.col("count")),
            finding(orders, "duplicate_reading_order", F.col("reading_order"), F.col("count")),
            finding(sections.where("NOT sha256 <=> sha2(text, 256)"), "text_hash_mismatch", F.col("section_id"), F.col("sha256")),
            finding(sections.where("page < 1 OR page > pdf_pages"), "page_out_of_range", F.col("section_id"), F.col("page")),
            finding(sections.where(F.contains("text", F.lit("�")) | F.rlike("text", F.lit(fixed.MISREAD_CYRILLIC))), "broken_encoding", F.col("section_id"), ""),
            finding(gaps, "chunk_gap", F.col("section_id"), F.col("chunk_no")),
            finding(chunks.join(sections, "section_id", "left_anti").select("section_id").distinct(), "orphan_chunk", F.col("section_id"), ""),
            finding(sections.where("text <> ''").join(chunks, "section_id", "left_anti"), "section_without_chunks", F.col("section_id"), ""),
            finding(sections.join(joined, "section_id").where("_whole <> text"), "chunks_lose_text", F.col("section_id"), ""),
        ]
    )


def media_findings(records: DataFrame, files: DataFrame) -> DataFrame:
    """(rule, ok, detail): checks of media records (figure_id, publication_status, public_path, public_asset_sha256, duplicate_of) against files (path, sha256)."""
    known = records.select(F.col("figure_id").alias("_id"), F.col("publication_status").alias("_status"))
    published = records.where("publication_status = 'published'")
    placed = published.join(files.select(F.col("path").alias("_path"), "sha256"), F.col("public_path") == F.col("_path"), "left")
    canon = records.where("publication_status = 'duplicate'").join(known, F.col("duplicate_of") == F.col("_id"), "left")
    rules = [
        ("ids_are_unique", records.groupBy("figure_id").count().where("count > 1")),
        ("published_has_path", published.where("public_path IS NULL")),
        ("published_file_exists", placed.where("_path IS NULL")),
        ("published_hash_matches", placed.where("sha256 <> public_asset_sha256")),
        ("duplicate_has_canonical", canon.where("_id IS NULL")),
        ("no_duplicate_of_duplicate", canon.where("_status = 'duplicate'")),
        ("unpublished_ships_nothing", records.where("publication_status NOT IN ('published', 'duplicate') AND public_path IS NOT NULL")),
        ("no_stray_files", files.join(records, F.col("path") == F.col("public_path"), "left_anti")),
        ("status_is_known", records.where("publication_status NOT IN ('published', 'duplicate', 'metadata_only_rights', 'metadata_only_source', 'decorative_excluded', 'technical_failure')")),
    ]
    return together([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), (F.col("n") == 0).alias("ok"), F.col("n").cast("string").alias("detail")) for rule, df in rules])


def split_findings(findings: DataFrame, authorial: str) -> DataFrame:
    """findings with is_blocking: those whose entity does not match the pattern of authorial paths."""
    return findings.withColumn("is_blocking", ~F.col("entity_key").rlike(authorial))
