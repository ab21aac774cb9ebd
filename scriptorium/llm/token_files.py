"""Token ids in Parquet files: encode, write in document order, read back whole or in part.

A file holds documents in ascending doc_id order; file part p holds smaller ids than part p + 1.
Columns: doc_id, part, local_start (ids of the documents before it in its part), n_tokens, ids.
The id lists are dictionary encoded, the numbers delta encoded (format version 2), row groups and
pages are kept small and carry column and offset indexes, so that a reader can fetch numbers without
ids, or the ids of a few documents without the rest.

Defined results: a null text is empty and gives the end id alone; a null doc_id comes first; rows with
equal doc_id follow each other by the hash of their text, equal rows in any order; an empty table gives
empty files; further columns of the input are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

END_ID = 2
#: Encoded pieces that a Python worker keeps, and how long they may be; beyond the number the store starts anew.
KEPT, KEPT_LENGTH = 600_000, 48
#: Bytes of text encoded at once.
SLICE_BYTES = 2 << 20
SCHEMA = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids array<int>"


#: The pattern of the tokenizer's byte-level pre-tokenizer, and the same for texts of Latin-1 characters alone.
_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_LATIN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")

#: Of the units of UTF-16, which an unassigned character may show: halves of characters beyond the basic plane, and its unassigned ones.
_ODD = np.array([0xD800 <= c < 0xE000 or unicodedata.category(chr(c)) == "Cn" for c in range(0x10000)])


def settled(text: str) -> bool:
    """Whether all characters are assigned: the pattern's module and the library know others by different versions of Unicode."""
    if not _ODD[np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")].any():
        return True
    return all(unicodedata.category(c) != "Cn" for c in set(text))


def _byte_letters() -> dict[int, str]:
    """The printable character by which byte-level BPE vocabularies write each byte."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}


class ChunkEncoder(dict):
    """Encodes texts with a byte-level BPE file of the tokenizers library, keeping the ids of frequent words.

    A text is cut by the pattern of the file's pre-tokenizer; the library's model encodes each piece, once
    for as long as it is kept. Texts with a special token's string or an unassigned character go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]).tobytes()
        if len(piece) <= KEPT_LENGTH:
            self[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as unsigned 32-bit integers."""
        if len(self) > KEPT:
            self.clear()
        out = []
        for text in texts:
            try:
                text.encode("latin-1")
                pieces = _LATIN.findall(text)
            except UnicodeEncodeError:
                pieces = _PATTERN.findall(text) if settled(text) else None
            if pieces is None or any(s in text for s in self.special):
                out.append(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes())
                continue
            out.append(b"".join(map(self.__getitem__, pieces)))
        return out


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One for each worker process."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, row_group_bytes: int = 16 << 20, page_rows: int = 1000) -> None:
    """Encode the texts of docs (doc_id, text) and write them to path."""
    spark = docs.sparkSession
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        coder = encoder(tokenizer)
        for batch in common.slices(batches, "text", SLICE_BYTES):
            found = [x + end for x in coder.encode(common.texts(batch.column("text")))]
            n = np.array([len(x) // 4 for x in found], np.int64)
            ends = np.cumsum(n)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.frombuffer(b"".join(found), np.int32)))
            starts = before + ends - n
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n), ids], names=["doc_id", "part", "local_start", "n_tokens", "ids"])

    order = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = order.repartitionByRange(common.partitions(spark), F.col("doc_id").asc_nulls_first())
    order = order.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    (
        order.mapInArrow(encode, SCHEMA).write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#local_start", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .parquet(path)
    )


def read(spark: SparkSession, path: str, columns: list[str] | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of the files with doc_id from first to last, of all columns or only those named; both reach the scan."""
    df = spark.read.schema(SCHEMA).parquet(path)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    if last is not None:
        df = df.where(F.col("doc_id") <= last)
    return df.select(*columns) if columns else df


def index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files: start counts the ids of all documents before."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds, values = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4", copy=False)
            found = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("local_start"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(np.array(found, np.int64))], names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])

    totals = read(spark, path, ["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file part
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))
    rows = read(spark, path, ["doc_id", "part", "local_start", "ids"]).mapInArrow(crc, "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(offsets, "part").select("doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
