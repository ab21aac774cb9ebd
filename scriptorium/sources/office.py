"""Texts and objects of office files: DOCX, ODT and EPUB as Markdown, streams of OLE compound files."""

from __future__ import annotations

import hashlib
import io
import posixpath
import re
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from .readers import _W, _local, _mapped


def _archive(data: bytes) -> zipfile.ZipFile | None:
    return zipfile.ZipFile(io.BytesIO(data)) if zipfile.is_zipfile(io.BytesIO(data)) else None


def _docx(z: zipfile.ZipFile) -> str:
    """Paragraphs apart, headings by their style, notes by number behind the text."""

    def words(p: ET.Element) -> str:
        parts = {"t": lambda e: e.text or "", "tab": lambda e: "\t", "br": lambda e: "\n", "footnoteReference": lambda e: f"[^{e.get(f'{_W}id')}]"}
        return "".join(parts[_local(e.tag)](e) for e in p.iter() if e.tag.startswith(_W) and _local(e.tag) in parts)

    def level(p: ET.Element) -> int:
        style = next((s.get(f"{_W}val", "") for s in p.iter(f"{_W}pStyle")), "")
        m = re.fullmatch(r"(?:[Hh]eading|Заголовок)?\s*([1-6])", style)
        return int(m[1]) if m else 0

    out = []
    for p in ET.fromstring(z.read("word/document.xml")).iter(f"{_W}p"):
        if text := words(p).strip():
            out.append("#" * level(p) + " " * bool(level(p)) + text)
    if "word/footnotes.xml" in z.namelist():
        for note in ET.fromstring(z.read("word/footnotes.xml")).iter(f"{_W}footnote"):
            text = " ".join(words(p).strip() for p in note.iter(f"{_W}p")).strip()
            if text and note.get(f"{_W}type") is None:
                out.append(f"[^{note.get(f'{_W}id')}]: {text}")
    return "\n\n".join(out)


def _odt(z: zipfile.ZipFile) -> str:
    def words(e: ET.Element) -> str:
        inner = {"tab": "\t", "line-break": "\n"}
        out = [e.text or ""]
        for child in e:
            tag = _local(child.tag)
            if tag == "s":
                out.append(" " * int(next((v for k, v in child.attrib.items() if _local(k) == "c"), 1)))
            elif tag != "note":
                out.append(inner.get(tag) or words(child))
            out.append(child.tail or "")
        return "".join(out)

    out = []
    for e in ET.fromstring(z.read("content.xml")).iter():
        if _local(e.tag) in ("h", "p") and (text := words(e).strip()):
            level = int(next((v for k, v in e.attrib.items() if _local(k) == "outline-level"), 1)) if _local(e.tag) == "h" else 0
            out.append("#" * min(level, 6) + " " * bool(level) + text)
    return "\n\n".join(out)


def _epub(z: zipfile.ZipFile) -> Iterator[str]:
    """The documents of the spine in order, as they stand."""
    root = next(e.get("full-path") for e in ET.fromstring(z.read("META-INF/container.xml")).iter() if _local(e.tag) == "rootfile")
    package = list(ET.fromstring(z.read(root)).iter())
    items = {e.get("id"): e.get("href") for e in package if _local(e.tag) == "item"}
    for e in package:
        if _local(e.tag) == "itemref" and e.get("idref") in items:
            name = posixpath.normpath(posixpath.join(posixpath.dirname(root), items[e.get("idref")]))
            if name in z.namelist():
                yield z.read(name).decode("utf-8", "replace")


def markdown(rows: DataFrame) -> DataFrame:
    """path and text of DOCX, ODT and EPUB files (path, content), told apart by what they hold; what cannot be read has null text."""

    def one(_: str, data: bytes) -> Iterator[tuple]:
        z = _archive(data)
        if z is None:
            yield 0, False, None
            return
        names = set(z.namelist())
        try:
            if "word/document.xml" in names:
                yield 0, False, _docx(z)
            elif "META-INF/container.xml" in names:
                for i, text in enumerate(_epub(z)):
                    yield i, True, text
            elif "content.xml" in names:
                yield 0, False, _odt(z)
            else:
                yield 0, False, None
        except (ET.ParseError, KeyError, StopIteration, zipfile.BadZipFile):
            yield 0, False, None

    parts = _mapped(rows, "path string, pos int, is_html boolean, text string", one)
    parts = parts.withColumn("text", F.when(F.col("is_html"), markup.html_to_markdown(F.col("text"))).otherwise(F.col("text")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.coalesce("text", F.lit("")) != "", F.struct("pos", "text")))), lambda x: x["text"]), "\n\n")
    return parts.groupBy("path").agg(F.nullif(joined, F.lit("")).alias("text"))


class Compound:
    """The streams of an OLE compound file, by path; chains that do not end raise ValueError."""

    FREE = 0xFFFFFFF0

    def __init__(self, data: bytes):
        if data[:8] != b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" or len(data) < 512:
            raise ValueError("no compound file")
        self.data = data
        shift, mini_shift = struct.unpack_from("<HH", data, 30)
        self.size, self.mini_size = 1 << shift, 1 << mini_shift
        n_fat, first_dir = struct.unpack_from("<I", data, 44)[0], struct.unpack_from("<I", data, 48)[0]
        self.cutoff, first_mini, _, first_more, n_more = struct.unpack_from("<5I", data, 56)
        tables = list(struct.unpack_from("<109I", data, 76))
        while n_more and first_more < self.FREE:
            more = self._numbers(self._sector(first_more))
            tables += more[:-1]
            first_more, n_more = more[-1], n_more - 1
        self.fat = [x for t in tables[:n_fat] if t < self.FREE for x in self._numbers(self._sector(t))]
        self.entries = self._directory(self._chain(first_dir, self.fat, self._sector))
        self.mini_fat = self._numbers(self._chain(first_mini, self.fat, self._sector)) if first_mini < self.FREE else []
        self.mini = self._chain(self.entries[0][2], self.fat, self._sector) if self.entries and self.entries[0][2] < self.FREE else b""

    @staticmethod
    def _numbers(block: bytes) -> list[int]:
        return list(struct.unpack(f"<{len(block) // 4}I", block[: len(block) // 4 * 4]))

    def _sector(self, i: int) -> bytes:
        if (i + 1) * self.size >= len(self.data):
            raise ValueError("cut short")
        return self.data[(i + 1) * self.size : (i + 2) * self.size]

    def _chain(self, at: int, table: list[int], read) -> bytes:
        out, steps = [], 0
        while at < self.FREE:
            if at >= len(table) or steps > len(table):
                raise ValueError("broken chain")
            out.append(read(at))
            at, steps = table[at], steps + 1
        return b"".join(out)

    @staticmethod
    def _directory(block: bytes) -> list[tuple[str, int, int, int]]:
        out = []
        for i in range(0, len(block) - 127, 128):
            length, kind = struct.unpack_from("<HB", block, i + 64)
            start, size = struct.unpack_from("<IQ", block, i + 116)
            out.append((block[i : i + max(0, min(length, 64) - 2)].decode("utf-16-le", "replace"), kind, start, size & 0xFFFFFFFF))
        return out

    def streams(self) -> dict[str, bytes]:
        out = {}
        for name, kind, start, size in self.entries:
            if kind == 2:
                small = size < self.cutoff
                read = (lambda i: self.mini[i * self.mini_size : (i + 1) * self.mini_size]) if small else self._sector
                out[name] = self._chain(start, self.mini_fat if small else self.fat, read)[:size] if size else b""
        return out


def ole_objects(rows: DataFrame) -> DataFrame:
    """path, kind (preview, document, other or unreadable), media_type, rights_status, publication_status, source_sha256 and streams of OLE objects.

    None is published: where such an object stands in the text is not known. A preview's hash is that of its picture, else the file's.
    """

    def one(_: str, data: bytes) -> Iterator[tuple]:
        sha = hashlib.sha256(data).hexdigest()
        try:
            found = Compound(data).streams()
        except (ValueError, struct.error):
            yield "unreadable", "other", "unknown", "technical_failure", sha, ""
            return
        names = ",".join(sorted(found))
        if "\x03EPRINT" in found:
            yield "preview", "scheme", "authorial", "metadata_only_source", hashlib.sha256(found["\x03EPRINT"]).hexdigest(), names
        elif "WordDocument" in found:
            yield "document", "other", "unknown", "metadata_only_source", sha, names
        else:
            yield "other", "other", "unknown", "technical_failure", sha, names

    return _mapped(rows, "path string, kind string, media_type string, rights_status string, publication_status string, source_sha256 string, streams string", one)
