"""Putting the registry of figures into the texts: references, and marks for what may not be shown.

A text with marks is taken apart into its own lines and the lines that an earlier run put in (they carry a tag), and put together
anew with all marks, each place's in the order of figure_id. So a run over what a run has made changes nothing, a reference takes
the place of a mark as soon as it may be shown, and a part of the figures first and the rest later give the text that all give at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, paths, text

#: Confidences of an anchor by which a figure may be placed without a human.
UNSURE = ("anchor_probable", "unbound_confirmed")
SHOWN = ("published", "duplicate")


def alt(record_caption: Column, label: Column, name: Column) -> Column:
    """The words of a reference, from the first there are; names of styles in them go."""
    first = F.coalesce(*[F.nullif(c, F.lit("")) for c in (record_caption, label, name)], F.lit(fixed.NO_ALT))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(first, r"[\[\]]", ""), fixed.GLUED_STYLE, ""), fixed.LEADING_STYLES, "")
    return text.alt_text(bare, fixed.NO_ALT)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once for each row however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lines_of(whole: Column) -> Column:
    """The lines of a text; the line end at its end is no further line."""
    unix = F.replace(whole, F.lit("\r\n"), F.lit("\n"))
    body = _let(unix, lambda x: F.when(F.endswith(x, F.lit("\n")), F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x))
    return F.split(body, "\n")  # one character is quicker than a pattern


def split_lines(files: DataFrame) -> DataFrame:
    """file, line_no, line of files (file, text); the line end at the end of a text is no further line, and a null text has none."""
    return files.where(F.coalesce("text", F.lit("")) != "").select("file", F.posexplode(_lines_of(F.col("text"))).alias("line_no", "line"))


_MARKED = "array<struct<figure_id: string, line_no: int, is_reference: boolean, line: string>>"


def taken_apart(lines: Column) -> Column:
    """Of the lines of a text: own, the text's own lines, and marked, the figures marked so far.

    The second has figure_id, line_no (of the own line before the mark, -1 at the beginning), is_reference and line. A blank line
    before the first tagged line of a run and one behind the last belong to the marks.
    """

    def of(both: Column) -> Column:
        tags, lines = both["tags"], both["lines"]
        tagged = lambda i: F.coalesce(F.get(tags, i) != "", F.lit(False))
        # a blank line between two tagged ones ends one run and begins none
        ours = F.transform(lines, lambda x, i: tagged(i) | ((F.trim(x) == "") & (tagged(i - 1) | tagged(i + 1))))

        def by(ours: Column) -> Column:
            # the place of a line among ours tells how many marks stand before it
            places = F.filter(F.transform(ours, lambda o, i: F.when(o, i)), lambda i: i.isNotNull())
            marks = F.filter(F.transform(places, lambda i, before: F.struct(i.alias("i"), (i - before - 1).alias("at"))), lambda m: tagged(m["i"]))
            each = lambda m, line: F.transform(F.split(F.get(tags, m["i"]), ","), lambda x: F.struct(x.alias("figure_id"), m["at"].alias("line_no"), F.ltrim(line).startswith("![").alias("is_reference"), line.alias("line")))
            marked = F.flatten(F.transform(marks, lambda m: each(m, F.get(lines, m["i"]))))
            return F.struct(F.filter(lines, lambda x, i: ~F.get(ours, i)).alias("own"), marked.cast(_MARKED).alias("marked"))

        return _let(ours, by)

    tags = F.transform(lines, lambda x: F.regexp_extract(x, fixed.FIGURE_TAG, 1))
    plain = F.struct(lines.alias("own"), F.array().cast(_MARKED).alias("marked"))
    return F.when(F.exists(lines, lambda x: F.contains(x, F.lit("figs:"))), _let(F.struct(tags.alias("tags"), lines.alias("lines")), of)).otherwise(plain)


def wanted(records: DataFrame) -> DataFrame:
    """records that belong into a text: anchored with confidence, and not there already by a reference of the text's own."""
    sure = F.col("anchor_file").isNotNull() & ~F.coalesce(F.col("anchor_confidence").isin(*UNSURE), F.lit(False))
    unseen = (F.col("source_kind") == "fb2_embedded") | ~F.coalesce("referenced_in_text", F.lit(False))
    return records.where(sure & unseen)


def _places(own: Column, asked: Column, within: int) -> Column:
    """asked (figure_id, line_no, sha and others) with at: the nearest line of own with that hash within so many, else the only one, else null."""
    sha = lambda x: F.sha2(text.squeeze(x), 256)
    there = lambda a: F.coalesce(F.get(own, a["line_no"]).isNotNull() & (a["sha"].isNull() | (sha(F.get(own, a["line_no"])) == a["sha"])), F.lit(False))
    steps = F.sequence(F.lit(-within), F.lit(within))

    def known(asked: Column) -> Column:
        def sought(shas: Column) -> Column:
            equal = lambda a: F.filter(steps, lambda x: F.get(shas, a["line_no"] + x) == a["sha"])
            near = lambda a: F.array_min(F.transform(equal(a), lambda x: F.struct(F.abs(x).alias("far"), (a["line_no"] + x).alias("at"))))["at"]
            first = lambda a: F.array_position(shas, a["sha"]).cast("int")
            only = lambda a: _let(first(a), lambda i: F.when((i > 0) & (F.array_position(F.slice(shas, i + 1, F.size(shas)), a["sha"]) == 0), i - 1))
            return F.transform(asked, lambda a: a.withField("at", F.when(a["at"].isNull() & a["sha"].isNotNull(), F.coalesce(near(a), only(a))).otherwise(a["at"]).cast("int")))

        # most anchors are at their lines; all lines are hashed only for those that are not
        lost = F.exists(asked, lambda a: a["sha"].isNotNull() & a["at"].isNull())
        return F.when(lost, _let(F.transform(own, sha), sought)).otherwise(asked)

    return _let(F.transform(asked, lambda a: a.withField("at", F.when(there(a), a["line_no"]))), known)


def _earlier(marked: Column) -> Column:
    """figure_id, kind 1, place, line (of a reference) and label of the figures marked so far, each once."""
    first = lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["figure_id"] != x["figure_id"], F.lit(True)))
    at = F.array_sort(F.transform(marked, lambda m: F.struct(m["figure_id"].alias("figure_id"), m["line_no"].alias("line_no"))))
    by = F.array_sort(F.transform(marked, lambda m: F.struct(m["figure_id"].alias("figure_id"), (~m["is_reference"]).alias("hidden"), m["line"].alias("line"))))
    label = lambda line: F.nullif(F.regexp_extract(line, r"\Q" + fixed.OMITTED_ONE.replace("{label}", r"\E «(.*)»\Q") + r"\E", 1), F.lit(""))
    mark = lambda a, b: F.struct(a["figure_id"].alias("figure_id"), F.lit(1).alias("kind"), a["line_no"].alias("place"), F.when(~b["hidden"], b["line"]).alias("line"), label(b["line"]).alias("label"))
    return F.zip_with(_let(at, first), _let(by, first), mark)


def _marks(parts: Column, asked: Column, within: int) -> Column:
    """figure_id, kind (0 of one asked, 1 of one that the registry at hand does not place), place, line and label of all marks of a text.

    A figure whose anchor is lost stays where an earlier run put it; the place of one that has none is null.
    """
    place = lambda a: a["at"] - F.when(a["mode"] == "before", 1).otherwise(0)
    now = F.transform(_places(parts["own"], asked, within), lambda a: F.struct(a["figure_id"].alias("figure_id"), F.lit(0).alias("kind"), place(a).alias("place"), a["reference"].alias("line"), a["label"].alias("label")))

    def merged(marks: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(marks, i)["figure_id"] == x["figure_id"], F.lit(False))
        # where the next of marks is of the same figure, it is the earlier mark, and goes
        was = F.transform(marks, lambda x, i: x.withField("place", F.coalesce(x["place"], F.when(same(x, i + 1), F.get(marks, i + 1)["place"]))))
        return F.filter(was, lambda x, i: (x["kind"] == 0) | ~same(x, i - 1))

    return _let(F.array_sort(F.concat(now, _earlier(parts["marked"]))), merged)


def _block(group: Column) -> Column:
    """The lines to put at one place: a blank one, the references, one mark for all that may not be shown, a blank one. group: in the order of figure_id."""
    hidden = F.filter(group, lambda x: x["line"].isNull())
    ids = F.array_join(F.transform(hidden, lambda x: x["figure_id"]), ",")
    label = F.get(F.filter(F.transform(hidden, lambda x: F.nullif(x["label"], F.lit(""))), lambda x: x.isNotNull()), F.lit(0))
    label = F.coalesce(F.concat(F.lit(" «"), label, F.lit("»")), F.lit(""))
    before, behind = fixed.OMITTED_ONE.split("{label}")
    one = F.concat(F.lit(before), label, F.lit(behind))
    before, behind = fixed.OMITTED_SEVERAL.split("{n}")
    several = F.concat(F.lit(before), F.size(hidden).cast("string"), F.lit(behind))
    mark = F.concat(F.when(F.size(hidden) == 1, one).otherwise(several), F.lit(" <!-- figs:"), ids, F.lit(" -->"))
    shown = F.transform(F.filter(group, lambda x: x["line"].isNotNull()), lambda x: x["line"])
    return F.concat(F.array(F.lit("")), shown, F.when(F.size(hidden) > 0, F.array(mark)).otherwise(F.array().cast("array<string>")), F.array(F.lit("")))


def _with_blocks(own: Column, marks: Column) -> Column:
    """own with the blocks of marks behind the lines of their places."""
    known = F.filter(marks, lambda x: x["place"].isNotNull())
    known = F.array_sort(F.transform(known, lambda x: F.struct(x["place"].alias("place"), x["figure_id"].alias("figure_id"), x["line"].alias("line"), x["label"].alias("label"))))

    def cut(both: Column) -> Column:
        rows, starts = both["rows"], both["starts"]
        group = lambda s, j: F.slice(rows, s + 1, F.coalesce(F.get(starts, j + 1), F.size(rows)) - s)
        # own lines from behind the place before up to this one, and its block
        prior = lambda j: F.coalesce(F.get(rows, F.get(starts, j - 1))["place"], F.lit(-1))
        piece = lambda s, j: F.concat(F.slice(own, prior(j) + 2, F.get(rows, s)["place"] - prior(j)), _let(group(s, j), _block))
        last = F.slice(own, prior(F.size(starts)) + 2, F.size(own))
        return F.concat(F.flatten(F.transform(starts, piece)), last)

    def by(rows: Column) -> Column:
        begins = F.transform(rows, lambda x, i: F.when(F.coalesce(F.get(rows, i - 1)["place"] != x["place"], F.lit(True)), i))
        return _let(F.struct(rows.alias("rows"), F.filter(begins, lambda i: i.isNotNull()).alias("starts")), cut)

    return F.when(F.exists(marks, lambda x: x["place"].isNotNull()), _let(known, by)).otherwise(own)


_ASKED = "array<struct<figure_id: string, line_no: int, sha: string, mode: string, reference: string, label: string>>"


def _shown() -> Column:
    return F.col("publication_status").isin(*SHOWN) & F.col("shipped").isNotNull()


def _by_file(records: DataFrame) -> DataFrame:
    """file and _asked, what is to be sought and put into it."""
    folder = F.regexp_replace("anchor_file", r"[^/]*$", "")
    reference = F.concat(F.lit("!["), alt(F.col("caption"), F.col("figure_label"), F.col("original_filename")), F.lit("]("), paths.relative(F.concat(folder, F.lit("x")), F.col("shipped")), F.lit(")<!-- figs:"), "figure_id", F.lit(" -->"))
    asked = wanted(records).dropDuplicates(["figure_id"])
    at = F.when(F.col("anchor_line").between(-(1 << 30), 1 << 30), F.col("anchor_line"))  # no text has a line farther off
    what = F.struct("figure_id", at.alias("line_no"), F.col("anchor_sha256").alias("sha"), F.col("anchor_mode").alias("mode"), F.when(_shown(), reference).alias("reference"), F.col("figure_label").alias("label"))
    return asked.groupBy(F.col("anchor_file").alias("file")).agg(F.collect_list(what).cast(_ASKED).alias("_asked"))


def _put(lines: Column, within: int, whole: Callable[[Column], Column]) -> Column:
    """done (what whole makes of the lines with the marks of _asked), and asked with figure_id and place of each."""
    asked = F.coalesce("_asked", F.array().cast(_ASKED))
    told = lambda marks: F.transform(F.filter(marks, lambda x: x["kind"] == 0), lambda x: F.struct(x["figure_id"].alias("figure_id"), x["place"].alias("place")))
    done = lambda parts, marks: F.struct(whole(_with_blocks(parts["own"], marks)).alias("done"), told(marks).alias("asked"))
    return _let(lines, lambda own: _let(taken_apart(own), lambda parts: _let(_marks(parts, asked, within), lambda marks: done(parts, marks))))


def _report(records: DataFrame, asked: DataFrame) -> DataFrame:
    """figure_id, outcome and file of records; asked: figure_id and place of those sought."""
    sought = asked.where("place IS NOT NULL").select("figure_id", F.lit(True).alias("_found"))
    rows = records.dropDuplicates(["figure_id"]).join(sought, "figure_id", "left").join(wanted(records).select("figure_id", F.lit(True).alias("_asked")).distinct(), "figure_id", "left")
    outcome = F.when(F.col("anchor_file").isNull(), "no_place").when(F.coalesce(F.col("anchor_confidence").isin(*UNSURE), F.lit(False)), "review").when(F.col("_asked").isNull(), "in_text").when(F.col("_found").isNull(), "mismatch")
    return rows.select("figure_id", outcome.otherwise(F.when(_shown(), "reference").otherwise("mark")).alias("outcome"), F.col("anchor_file").alias("file"))


def placed_texts(files: DataFrame, records: DataFrame, within: int = 40) -> tuple[DataFrame, DataFrame]:
    """files (file, text and further columns) with the marks of records in their texts, and what became of each record; empty texts go.

    records: figure_id, anchor_file, anchor_line, anchor_sha256 (of the squeezed line), anchor_mode (before or after), anchor_confidence,
    source_kind, referenced_in_text, publication_status, shipped (path of the file that ships, from where the texts' paths begin, or
    null), caption, figure_label, original_filename. An anchor is sought at its line, else within so many lines, else in the whole
    file if it is there once; a figure whose anchor is lost stays where an earlier run put it. The second has figure_id, outcome
    (reference, mark, review, mismatch, in_text, no_place) and file. A text meets the records of its file in one shuffle, and lines are
    never rows: what is done with them is done within the text.
    """
    others = [c for c in files.columns if c not in ("file", "text")]
    put = _put(_lines_of(F.col("text")), within, lambda lines: F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    # by explode, the text is made once, whatever is then asked of it
    rows = files.join(_by_file(records), "file", "left").select("file", *others, F.explode(F.when(F.coalesce("text", F.lit("")) != "", F.array(put))).alias("_put"))
    return rows.select("file", F.col("_put.done").alias("text"), *others), _report(records, rows.select(F.inline("_put.asked")))


def placed(lines: DataFrame, records: DataFrame, within: int = 40) -> tuple[DataFrame, DataFrame]:
    """placed_texts() of texts as lines (file, line_no, line): file, line_no, line in order (line_no counts anew), and the report."""
    texts = lines.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_lines"))
    put = _put(F.transform("_lines", lambda x: x["line"]), within, lambda done: done)
    rows = texts.join(_by_file(records), "file", "left").select("file", F.explode(F.array(put)).alias("_put"))
    return rows.select("file", F.posexplode("_put.done").alias("line_no", "line")), _report(records, rows.select(F.inline("_put.asked")))


def joined(lines: DataFrame) -> DataFrame:
    """file and text of placed() lines."""
    whole = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    return lines.groupBy("file").agg(F.concat(F.array_join(whole, "\n"), F.lit("\n")).alias("text"))


def renamed_references(lines: DataFrame, records: DataFrame) -> DataFrame:
    """lines with references to a media_file whose shipped copy has another extension led to that: `/name)` and `/name"`.

    records: media_file, ref_sites (the files that refer to it), publication_status, shipped. Of several copies the first name counts.
    """
    ext = lambda c: F.lower(F.regexp_extract(c, r"(\.[^./]*)$", 1))
    name = F.substring_index("shipped", "/", -1)
    moved = records.where(F.col("publication_status").isin(*SHOWN) & F.col("shipped").isNotNull() & (F.coalesce("media_file", F.lit("")) != "") & (ext(F.col("media_file")) != ext(name)))
    moved = moved.select(F.explode("ref_sites").alias("file"), F.col("media_file").alias("old"), name.alias("new")).groupBy("file", "old").agg(F.min("new").alias("new"))
    seen = lines.select("file", "line_no", F.explode(F.array_distinct(F.regexp_extract_all("line", F.lit(r'/([^/()"\s]+)[)"]'), 1))).alias("old"))
    by = seen.join(moved, ["file", "old"]).groupBy("file", "line_no").agg(F.array_sort(F.collect_list(F.struct("old", "new"))).alias("_moved"))
    led = lambda line, m: F.replace(F.replace(line, F.concat(F.lit("/"), m["old"], F.lit(")")), F.concat(F.lit("/"), m["new"], F.lit(")"))), F.concat(F.lit("/"), m["old"], F.lit('"')), F.concat(F.lit("/"), m["new"], F.lit('"')))
    rows = lines.join(by, ["file", "line_no"], "left")
    return rows.withColumn("line", F.when(F.col("_moved").isNotNull(), F.aggregate("_moved", F.col("line"), led)).otherwise(F.col("line"))).drop("_moved")


def shipped_files(records: DataFrame, staged: DataFrame, root: str = "media") -> DataFrame:
    """records with staged (the file that holds its object) and shipped (where it ships): its own, or its canonical record's if that is published.

    staged: figure_id, name of the file made of a record's object. A record that ships nothing has nulls; needs_file tells one that should.
    """
    own = staged.select(F.col("figure_id").alias("_asset"), F.col("name").alias("staged"))
    status = records.select(F.col("figure_id").alias("_asset"), F.col("publication_status").alias("_status"))
    asset = F.when(F.col("publication_status") == "published", F.col("figure_id")).when(F.col("publication_status") == "duplicate", F.col("duplicate_of"))
    rows = records.withColumn("_asset", asset).join(status.dropDuplicates(["_asset"]), "_asset", "left").join(own, "_asset", "left")
    ships = F.col("_status") == "published"
    rows = rows.withColumn("staged", F.when(ships, F.col("staged"))).withColumn("needs_file", F.coalesce(ships, F.lit(False)) & F.col("staged").isNull())
    ext = lambda c: F.lower(F.regexp_extract(c, r"(\.[^./]*)$", 1))
    base = F.coalesce("media_file", "original_filename", "staged")
    name = F.when(ext(base) == ext(F.col("staged")), base).otherwise(F.concat(F.regexp_replace(base, r"\.[^./]*$", ""), F.regexp_extract("staged", r"(\.[^./]*)$", 1)))
    return rows.withColumn("shipped", F.when(F.col("staged").isNotNull(), F.concat(F.col("work_id"), F.lit(f"/{root}/"), name))).drop("_asset", "_status")
