"""What the operators of this subpackage share: places for cut lineage, and reading of tables."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id where ids are compared: null comes before every other id.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new local one where it is unset and all runs on one machine (tests)."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="scriptorium-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []


def cut(df: DataFrame, what: str = "cut", keep: bool = False) -> DataFrame:
    """df as a table written to the shared folder and read again: short lineage that outlives lost executors.

    Within scratch() the table goes at its end; if it is to be kept, at the end of the scratch() around that, if any.
    """
    path = new_path(df.sparkSession, what)
    if len(_scratch) > keep:
        _scratch[-1 - keep].append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_to = path
    return out


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete tables that cut() wrote."""
    conf = spark._jsc.hadoopConfiguration()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables cut within and not kept are deleted at the end: what is computed within must not be read lazily from them afterwards."""
    _scratch.append([])
    try:
        yield
    finally:
        drop(spark, *_scratch.pop())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose column holds about limit bytes; a longer single row stays whole."""
    for batch in batches:
        size = batch.column(column)
        lengths = pa.compute.fill_null(pa.compute.binary_length(size), 0).to_pylist()
        first = total = 0
        for i, n in enumerate(lengths):
            if total and total + n > limit:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        if first < len(lengths):
            yield batch.slice(first)


def texts(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [x or "" for x in column.to_pylist()]


#: Rows (of a few numbers each) that are broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 2_000_000
#: Rows among which all keys are broadcast.
LOOKUP_ROWS = 1_000_000
#: A key is hot if it has more than 200 rows and more than one in HOT_KEYS of all rows.
HOT_ROWS, HOT_KEYS = 200, 100_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df, broadcast if it has limit rows or fewer."""
    return F.broadcast(df) if df.count() <= limit else df


def lookup(rows: DataFrame, side: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """rows joined with side, which has one row for each key and in n how many of the total rows have it.

    No task gathers the rows of a hot key: side is broadcast if there are LOOKUP_ROWS rows or fewer, else the hot keys, HOT_KEYS
    at most, meet their rows by broadcast and the others by shuffle.
    """
    if total <= LOOKUP_ROWS:
        return rows.join(F.broadcast(side), key)
    limit = max(HOT_ROWS, total // HOT_KEYS)
    hot = F.broadcast(side.where(F.col(n) > limit))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(side.where(F.col(n) <= limit), key))


@contextlib.contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Within, rows go to Python workers in batches of about size bytes: a worker that also holds groups has less to hold."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Return what the allocators of this worker hold unused to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def packed(docs: DataFrame, *own: str) -> DataFrame:
    """The columns own of docs, and all others in one, rest: names that an operator adds cannot clash with those of its input."""
    others = [c for c in docs.columns if c not in own]
    return docs.select(*own, *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")] if others else []))


def unpacked(rows: DataFrame, columns: list[str], *own: str) -> DataFrame:
    """columns, in their order, of rows that packed() began."""
    return rows.select(*[F.col(c) if c in own else F.col(f"rest.`{c}`").alias(c) for c in columns])
