"""Marks of figures in texts: placed once, whatever runs came before."""

import hashlib
import random

from pyspark.sql import functions as F

from scriptorium.functions import fixed
from scriptorium.operators import placement

SCHEMA = """figure_id string, anchor_file string, anchor_line int, anchor_sha256 string, anchor_mode string, anchor_confidence string, source_kind string, referenced_in_text boolean,
publication_status string, shipped string, caption string, figure_label string, original_filename string"""
TEXT = "# Head\nfirst line\n\nsecond *line*\nthird\n\n\nlast\n"


def sha(line):
    return hashlib.sha256(line.encode()).hexdigest()


def record(fid, line, at, mode="after", status="published", shipped="w/media/a.png", caption="Cap", label=None, file="w/t/a.md", confidence="anchor_exact", kind="fb2_embedded", referenced=True):
    return (fid, file, at, None if line is None else sha(line), mode, confidence, kind, referenced, status, shipped if status == "published" else None, caption, label, "orig.png")


def run(spark, text, records, file="w/t/a.md"):
    lines = placement.split_lines(spark.createDataFrame([(file, text)], "file string, text string"))
    out, report = placement.placed(lines, spark.createDataFrame(records, SCHEMA))
    found = placement.joined(out).collect()
    return found[0].text if found else "", {r.figure_id: r.outcome for r in report.collect()}


def test_references_and_marks(spark):
    records = [
        record("f2", "first line", 1), record("f1", "first line", 1, status="metadata_only_rights", label="Рис. 1"), record("f3", "second line", 3, mode="before", caption="[x1]  ab12Схема"), record("f4", "last", 30),
        record("f5", "nowhere", 2), record("f6", "third", 4, confidence="anchor_probable"), record("f7", "third", 4, kind="docx_embedded"), record("f8", "third", 4, file=None),
        record("g1", "third", 4, status="metadata_only_rights"), record("g2", "third", 4, status="metadata_only_source", label="Рис. 2"),
    ]
    text, told = run(spark, TEXT, records)
    one = fixed.OMITTED_ONE.format(label=" «Рис. 1»") + " <!-- figs:f1 -->"
    two = fixed.OMITTED_SEVERAL.format(n=2) + " <!-- figs:g1,g2 -->"
    assert text.split("\n") == [
        "# Head", "first line", "", "![Cap](../media/a.png)<!-- figs:f2 -->", one, "", "", "", "![Схема](../media/a.png)<!-- figs:f3 -->", "", "second *line*", "third", "", two, "", "", "", "last", "",
        "![Cap](../media/a.png)<!-- figs:f4 -->", "", "",
    ]
    assert told == {"f1": "mark", "f2": "reference", "f3": "reference", "f4": "reference", "f5": "mismatch", "f6": "review", "f7": "in_text", "f8": "no_place", "g1": "mark", "g2": "mark"}


def test_any_order_of_runs_gives_the_same_text(spark):
    rng = random.Random(0)
    words = ["", "", "alpha", "beta *x*", "gamma", "delta"]
    texts = {f"w/{i}.md": "\n".join(rng.choice(words) + (f" {j}" if rng.random() < 0.7 else "") for j in range(rng.randint(1, 12))) + "\n" for i in range(20)}
    records = []
    for i, (file, text) in enumerate(texts.items()):
        own = text[:-1].split("\n")
        for k in range(rng.randint(0, 6)):
            at = rng.randrange(len(own))
            status = rng.choice(["published", "metadata_only_rights"])
            records.append(record(f"f{i}-{k}", " ".join(own[at].replace("*", "").split()), at, rng.choice(["before", "after"]), status, "w/media/a.png", rng.choice(["C", None]), rng.choice(["L", None]), file))
    lines = placement.split_lines(spark.createDataFrame(list(texts.items()), "file string, text string"))
    df = spark.createDataFrame(records, SCHEMA)

    def applied(files, some):
        out = placement.joined(placement.placed(placement.split_lines(spark.createDataFrame(sorted(files.items()), "file string, text string")), some)[0])
        return {r.file: r.text for r in out.collect()}

    whole = applied(texts, df)
    assert applied(whole, df) == whole and lines.count() > 0
    part = df.where(F.abs(F.xxhash64("figure_id")) % 2 == 0)
    assert applied(applied(texts, part), df.join(part.select("figure_id"), "figure_id", "left_anti")) == whole
    # what was blocked and is published now takes the place of its mark, in a text as if it had been so from the beginning
    freed = df.withColumn("shipped", F.lit("w/media/a.png")).withColumn("publication_status", F.lit("published"))
    assert applied(whole, freed) == applied(texts, freed)


def test_empty_texts_and_records(spark):
    assert run(spark, TEXT, [record("f1", "zzz", 0)]) == (TEXT, {"f1": "mismatch"})
    assert run(spark, None, [record("f1", "zzz", 0)]) == ("", {"f1": "mismatch"})
    lines = placement.split_lines(spark.createDataFrame([("a", TEXT)], "file string, text string"))
    out, report = placement.placed(lines, spark.createDataFrame([], SCHEMA))
    assert placement.joined(out).first().text == TEXT and report.count() == 0


def test_renamed_references_and_shipped_files(spark):
    records = spark.createDataFrame([
        ("f1", "w", "published", None, "a.wmf", "a.wmf", ["w/1.md", "w/2.md"]), ("f2", "w", "duplicate", "f1", "b.emf", "b.emf", ["w/1.md"]), ("f3", "w", "duplicate", "f4", "c.png", "c.png", ["w/1.md"]), ("f4", "w", "metadata_only_rights", None, "d.png", "d.png", []), ("f5", "w", "published", None, "e.png", "e.png", []),
    ], "figure_id string, work_id string, publication_status string, duplicate_of string, media_file string, original_filename string, ref_sites array<string>")
    ships = placement.shipped_files(records, spark.createDataFrame([("f1", "f1.png")], "figure_id string, name string"))
    assert {r.figure_id: (r.shipped, r.needs_file) for r in ships.collect()} == {"f1": ("w/media/a.png", False), "f2": ("w/media/b.png", False), "f3": (None, False), "f4": (None, False), "f5": (None, True)}
    lines = spark.createDataFrame([("w/1.md", 0, '![x](media/a.wmf) <img src="m/b.emf"> (a.wmf) ![](media/a.wmf)'), ("w/2.md", 0, "![](media/b.emf)"), ("w/3.md", 0, "![](media/a.wmf)")], "file string, line_no int, line string")
    got = {r.file: r.line for r in placement.renamed_references(lines, ships).collect()}
    assert got == {"w/1.md": '![x](media/a.png) <img src="m/b.png"> (a.wmf) ![](media/a.png)', "w/2.md": "![](media/b.emf)", "w/3.md": "![](media/a.wmf)"}
    again = placement.renamed_references(spark.createDataFrame([(f, 0, t) for f, t in got.items()], "file string, line_no int, line string"), ships)
    assert {r.file: r.line for r in again.collect()} == got


def test_texts_are_read_once_however_many_runs(spark, tmp_path):
    texts = spark.createDataFrame([("w/t/a.md", TEXT), ("w/t/b.md", "x\r\ny\r\n"), ("w/t/c.md", ""), ("w/t/d.md", None)], "file string, text string")
    texts.write.parquet(str(tmp_path / "texts"))
    records = spark.createDataFrame([record("f1", "first line", 1), record("f2", "y", 1, mode="before", file="w/t/b.md")], SCHEMA)
    files = spark.read.parquet(str(tmp_path / "texts"))
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Scan parquet")
    lines = placement.placed(placement.split_lines(files), records)[0]
    assert scans(lines) == 1
    assert scans(placement.placed(placement.split_lines(placement.joined(lines)), records)[0]) == 1
    once = placement.placed_texts(files.withColumn("n", F.length("text")), records)[0]
    twice = placement.placed_texts(once.withColumn("first", F.col("text")), records)[0]
    assert scans(twice) == 1
    got = {r.file: r for r in twice.collect()}
    assert {f: (r.n, r.text == r.first) for f, r in got.items()} == {"w/t/a.md": (len(TEXT), True), "w/t/b.md": (6, True)}
    assert got["w/t/b.md"].text == "x\n\n![Cap](../media/a.png)<!-- figs:f2 -->\n\ny\n"
    assert got["w/t/a.md"].text == {r.file: r.text for r in placement.joined(lines).collect()}["w/t/a.md"]


def test_anchors_off_their_lines(spark):
    own = [f"l{i}" for i in range(200)]
    own[10] = own[14] = own[100] = own[190] = "twin"
    own[150] = "> *one*"
    asked = {"a1": ("twin", 12), "a2": ("twin", 13), "a3": ("twin", 55), "a4": ("one", 2**31 - 1), "a5": ("twin", -(2**31)), "a6": ("l7", -5), "a7": ("l199", None), "a8": (None, 3), "a9": (None, 200)}
    records = [record(f, line, at) for f, (line, at) in asked.items()]
    text, told = run(spark, "\n".join(own), records)
    # the nearest, the earlier of two; one farther than 40 lines only if it is the only one; without a hash the line itself
    assert {f for f, outcome in told.items() if outcome == "mismatch"} == {"a3", "a5", "a9"}
    lines = text.split("\n")
    behind = {f: next(x for x in lines[lines.index(f"![Cap](../media/a.png)<!-- figs:{f} -->") :: -1] if x and "figs:" not in x) for f in asked if told[f] == "reference"}
    assert behind == {"a1": "twin", "a2": "twin", "a4": "> *one*", "a6": "l7", "a7": "l199", "a8": "l3"}
    assert [i for i, x in enumerate(lines) if "figs:a1 " in x] < [lines.index("l11")] < [i for i, x in enumerate(lines) if "figs:a2 " in x] < [lines.index("l15")]


def test_marks_of_several_figures_are_told_apart(spark):
    """Of a mark of two, one is now shown elsewhere and the other stays; a blank line between two marks is no text."""
    two = fixed.OMITTED_SEVERAL.format(n=2)
    text = f"head\n\n{two} <!-- figs:k1,k2 -->\n\n![K](k.png)<!-- figs:k3 -->\n\nlast\n"
    got, told = run(spark, text, [record("k1", "last", 1)])
    one = fixed.OMITTED_ONE.format(label="") + " <!-- figs:k2 -->"
    assert got == f"head\n\n![K](k.png)<!-- figs:k3 -->\n{one}\n\nlast\n\n![Cap](../media/a.png)<!-- figs:k1 -->\n\n" and told == {"k1": "reference"}
