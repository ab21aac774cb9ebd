"""Files are written all or not at all."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from scriptorium.sources import sinks


def tree(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(root) for f in names}


def test_pages(spark, tmp_path):
    root = str(tmp_path / "site")
    rows = spark.range(40).select(F.concat(F.lit("w/"), (F.col("id") % 4).cast("string"), F.lit("/"), F.col("id").cast("string"), F.lit(".md")).alias("path"), F.concat(F.lit("é "), F.col("id").cast("string")).alias("text"))
    sinks.pages(rows.repartition(5), root)
    written = tree(root)
    assert len(written) == 40 and written["w/3/7.md"] == "é 7".encode()
    sinks.pages(spark.createDataFrame([("w/3/7.md", "new"), ("x.md", None)], "path string, text string"), root)
    assert tree(root) == {**written, "w/3/7.md": b"new", "x.md": b""}
    assert not [d for d in os.listdir(root) if d.startswith(".staging")]


def test_a_failing_task_leaves_the_folder_as_it_was(spark, tmp_path):
    root = str(tmp_path / "site")
    sinks.pages(spark.createDataFrame([("a.md", "old")], "path string, text string"), root)
    before = tree(root)
    rows = [(f"n{i}.md", "new") for i in range(20)] + [("a.md", "new")]
    for bad in [("../out.md", "x"), ("n3.md", "again")]:
        with pytest.raises(Exception):
            sinks.pages(spark.createDataFrame(rows + [bad], "path string, text string").repartition(4), root)
        assert tree(root) == before and not os.path.exists(tmp_path / "out.md")


def test_assets(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    rows = []
    for i in range(6):
        (source / f"{i}.png").write_bytes(bytes([i]) * 2_000_000)
        rows.append((str(source / f"{i}.png"), f"m/{i}.png", hashlib.sha256(bytes([i]) * 2_000_000).hexdigest()))
    schema = "source string, path string, sha256 string"
    with pytest.raises(Exception, match="has changed"):
        sinks.assets(spark.createDataFrame(rows[:5] + [(*rows[5][:2], "0" * 64)], schema).repartition(3), root)
    assert tree(root) == {}
    sinks.assets(spark.createDataFrame(rows, schema).repartition(3), root)
    assert tree(root) == {f"m/{i}.png": bytes([i]) * 2_000_000 for i in range(6)}
