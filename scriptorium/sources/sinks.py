"""Sinks: JSON lines, single documents, pages and assets. Repeating a task is harmless, and a job that fails leaves no part of its files."""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def check_output(out: str, sources: list[str]) -> None:
    """Refuse an output folder that is, holds, or lies in one of the sources."""
    a = PurePosixPath(os.path.normpath(os.path.abspath(out)))
    for source in sources:
        b = PurePosixPath(os.path.normpath(os.path.abspath(source)))
        if a == b or a in b.parents or b in a.parents:
            raise ValueError(f"the output {out} overlaps the source {source}")


def json_lines(rows: DataFrame, path: str, drop_nulls: bool = True) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", str(drop_nulls).lower()).json(path)


def one_document(rows: DataFrame, path: str, column: str = "json") -> None:
    """Write the one value of a one-row table as a text file of one part."""
    rows.select(column).coalesce(1).write.mode("overwrite").option("lineSep", "").text(path)


def _safe(root: str, path: str) -> str:
    target = os.path.normpath(os.path.join(root, path))
    if not target.startswith(os.path.normpath(root) + os.sep):
        raise ValueError(f"{path} leads out of the output folder")
    return target


@dataclass
class _Staged(WriterCommitMessage):
    """Files that one task has staged: their places in the staging folder and below the output folder."""

    files: list[tuple[str, str]]


class _FilesWriter(DataSourceWriter):
    """Writes each row as a file. Tasks stage what they write in a folder of the job; only what committed tasks staged moves to its place."""

    def __init__(self, root: str, kind: str):
        self.root, self.kind = os.path.normpath(root), kind
        self.staging = os.path.join(self.root, f".staging-{uuid.uuid4().hex}")

    def _content(self, row) -> Iterator[bytes]:
        if self.kind == "pages":
            yield (row["text"] or "").encode()
            return
        found = hashlib.sha256()
        with open(row["source"], "rb") as f:
            while part := f.read(1 << 20):
                found.update(part)
                yield part
        if found.hexdigest() != row["sha256"]:
            raise ValueError(f"{row['source']} has changed: {found.hexdigest()}")

    def write(self, iterator) -> _Staged:
        own = os.path.join(self.staging, uuid.uuid4().hex)  # of this attempt: one that is repeated or runs twice stages anew
        files = []
        for i, row in enumerate(iterator):
            target = _safe(self.root, row["path"])
            os.makedirs(own, exist_ok=True)
            staged = os.path.join(own, str(i))
            with open(staged, "wb") as f:
                for part in self._content(row):
                    f.write(part)
            files.append((staged, target))
        return _Staged(files)

    def commit(self, messages: list) -> None:
        targets = [t for m in messages if m for _, t in m.files]
        if len(set(targets)) < len(targets):
            self.abort(messages)
            raise ValueError("two rows have one path")
        for message in messages:
            for staged, target in message.files if message else []:
                os.makedirs(os.path.dirname(target), exist_ok=True)
                os.replace(staged, target)
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class Files(DataSource):
    """Spark data source of format files: one file a row below root, a folder that the driver and all executors share."""

    @classmethod
    def name(cls) -> str:
        return "files"

    def writer(self, schema: StructType, overwrite: bool) -> _FilesWriter:
        return _FilesWriter(self.options["root"], self.options["kind"])


def _write_files(rows: DataFrame, root: str, kind: str) -> None:
    rows.sparkSession.dataSource.register(Files)
    rows.write.format("files").mode("append").option("root", root).option("kind", kind).save()


def pages(rows: DataFrame, root: str, path: str = "path", body: str = "text") -> None:
    """One file a row below root, a folder that all executors share: all of them, or none if the job fails; two rows of one path are an error."""
    _write_files(rows.select(F.col(path).alias("path"), F.col(body).alias("text")), root, "pages")


def assets(rows: DataFrame, root: str) -> None:
    """Copy source to path below root for every row (source, path, sha256): all, or none if a file has another hash or the job fails otherwise."""
    _write_files(rows.select("source", "path", "sha256"), root, "assets")


def pending(files: DataFrame, done: DataFrame) -> DataFrame:
    """files (path, content) whose hash is not among those done (sha256): what an earlier run converted is not converted again."""
    return files.withColumn("sha256", F.sha2(F.col("content").cast("binary"), 256)).join(done.select("sha256"), "sha256", "left_anti")
