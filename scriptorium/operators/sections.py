"""Works, sections, chunks, units, footnotes and their order."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, paths, text
from . import grams, ranges


def sections(docs: DataFrame) -> DataFrame:
    """section_id, work_id, language, title (first line) and body of documents (doc_id, source, lang, text)."""
    return docs.select(F.col("doc_id").alias("section_id"), F.col("source").alias("work_id"), F.col("lang").alias("language"), text.title_of(F.col("text")).alias("title"), F.col("text").alias("body"))


def in_reading_order(sections: DataFrame, work: str = "work_id", order: str = "section_id") -> DataFrame:
    """sections with reading_order, their number in their work."""
    return ranges.numbered(sections, work, order, "reading_order")


def chunk_ranges(value: Column, limit: int = fixed.CHUNK_LIMIT, separator: str = "\n\n") -> Column:
    """array<struct<start, stop>>: a chunk holds limit characters at most and ends behind a separator in its latter part, if there is one.

    A fold over the places behind separators. held: the last such place that may end the chunk begun at start.
    """
    least = max(fixed.CHUNK_LEAST, limit // 3) + len(separator)
    pieces = F.split(F.coalesce(value, F.lit("")), rf"(?<=\Q{separator}\E)")
    none = F.array().cast("array<struct<start:int,stop:int>>")
    chunk = lambda start, stop: F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"))

    def further(acc: Column, piece: Column) -> Column:
        place = acc["place"] + F.length(piece)
        over = place - acc["start"] > limit
        cut = over & (acc["held"] > acc["start"])
        begun = F.when(cut, acc["held"]).otherwise(acc["start"])
        # without a place to end at, chunks of limit characters until this place is within reach
        whole = F.when(over & (place - begun > limit), F.ceil((place - begun) / limit).cast("int") - 1).otherwise(0)
        start = begun + whole * limit
        forced = F.when(whole > 0, F.transform(F.sequence(F.lit(1), whole), lambda i: chunk(begun + (i - 1) * limit, begun + i * limit))).otherwise(none)
        cuts = F.when(over, F.concat(acc["cuts"], F.when(cut, F.array(chunk(acc["start"], acc["held"]))).otherwise(none), forced)).otherwise(acc["cuts"])
        held = F.when(place - start >= least, place).when(over, -1).otherwise(acc["held"])
        return F.struct(place.alias("place"), start.alias("start"), held.alias("held"), cuts.alias("cuts"))

    first = F.struct(F.lit(0).alias("place"), F.lit(0).alias("start"), F.lit(-1).alias("held"), none.alias("cuts"))
    last = lambda acc: F.when(acc["place"] > acc["start"], F.concat(acc["cuts"], F.array(chunk(acc["start"], acc["place"])))).otherwise(acc["cuts"])
    return F.aggregate(pieces, first, further, last)


def chunks(docs: DataFrame, key: str = "doc_id", body: str = "text", limit: int = fixed.CHUNK_LIMIT, separator: str = "\n\n") -> DataFrame:
    """key, chunk_no, start_char, end_char and text of every chunk."""
    rows = docs.select(key, F.col(body).alias("_body"), F.posexplode(chunk_ranges(F.col(body), limit, separator)).alias("chunk_no", "r"))
    return rows.select(key, "chunk_no", F.col("r.start").alias("start_char"), F.col("r.stop").alias("end_char"), F.substring("_body", F.col("r.start") + 1, F.col("r.stop") - F.col("r.start")).alias("text"))


def back_propagated(rows: DataFrame, sections: DataFrame, key: str, section_key: str, column: str) -> DataFrame:
    """rows (chunks or figures) with column as their section, named by key, has it now: null where the section has none or is unknown."""
    held = sections.select(F.col(section_key).alias("_key"), F.col(column).alias("_value"))
    return rows.drop(column).join(held, F.col(key) == F.col("_key"), "left").withColumn(column, F.col("_value")).drop("_key", "_value")


def path_index(sections: DataFrame, order: str, path: str = "path", key: str = "section_id") -> DataFrame:
    """path and the key of the last section by order that has it."""
    return sections.groupBy(path).agg(F.max_by(key, order).alias(key))


def kind_counts(rows: DataFrame, kind: str = "kind") -> DataFrame:
    """kind and n."""
    return rows.groupBy(F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def largest(rows: DataFrame, group: str, body: str = "text") -> DataFrame:
    """group and the bytes of its largest section."""
    return rows.groupBy(group).agg(F.max(F.octet_length(body)).cast("bigint").alias("max_bytes"))


def title_collisions(rows: DataFrame, key: str, title: str = "title") -> DataFrame:
    """key, title and how many sections have it, of titles that several have."""
    counts = rows.groupBy(title).agg(F.count(F.lit(1)).alias("n_sections")).where("n_sections > 1")
    return rows.join(counts, title).select(key, title, "n_sections")


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key and side (left or right) of keys that only one side has."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(1)), right.select(key).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, key, "full_outer").where("_a IS NULL OR _b IS NULL")
    return both.select(key, F.when(F.col("_b").isNull(), "left").otherwise("right").alias("side"))


def multiset_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, n_left and n_right of keys that the sides do not hold equally often: none, if they are equal as multisets."""
    count = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    both = count(left, "n_left").join(count(right, "n_right"), key, "full_outer")
    both = both.select(key, F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))
    return both.where("n_left <> n_right")


def intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The distinct keys of both sides."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi")


def keyed_union(sides: list[DataFrame], columns: list[str]) -> DataFrame:
    """The distinct rows of all sides."""
    out = sides[0].select(*columns)
    for side in sides[1:]:
        out = out.unionByName(side.select(*columns))
    return out.distinct()

def contiguity(chunked: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_chunks and n_gaps: chunks that do not begin where the one before ends, or whose length is not theirs."""
    before = F.lag("end_char", 1, 0).over(Window.partitionBy(key).orderBy("chunk_no"))
    odd = (F.col("start_char") != before) | (F.col("end_char") - F.col("start_char") != F.length("text"))
    return chunked.withColumn("odd", odd.cast("int")).groupBy(key).agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("odd").alias("n_gaps"))


def rejoined(parts: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """key and the parts of each key joined in order."""
    return parts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda p: p[value]), "").alias("whole"))


def lines(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """key, line_no (from 0) and line."""
    return docs.select(key, F.posexplode(F.split(F.coalesce(body, F.lit("")), "\n")).alias("line_no", "line"))


def numbered_runs(rows: DataFrame, key: str, order: str, starts: Column) -> DataFrame:
    """rows with run_no: how many rows that start a run there are up to each."""
    return ranges.running_sum(rows, key, order, starts.cast("int"), "run_no")


def units(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """key, unit_no, kind, unit_id, title, path and raw text of each unit that headings begin; raw texts in order are the body.

    A number before a section's heading counts within the chapter or appendix that is current.
    """
    rows = docs.select(key, F.posexplode(F.split(F.coalesce(body, F.lit("")), r"(?<=\n)")).alias("line_no", "line")).where("line <> ''")
    w = Window.partitionBy(key).orderBy("line_no")
    line, bare = F.col("line"), text.plain(F.regexp_replace(F.trim(F.regexp_replace("line", r"[\r\n]+$", "")), r"^[# ]+", ""))
    number = lambda pattern, group=1: F.expr(f"try_cast(nullif(regexp_extract(line, r'{pattern}', {group}), '') AS int)")
    chapter, appendix = number(r"(?iu)^#\s+Глава\s+(\d+)\."), number(r"(?iu)^#\s+Приложение[\s\x{a0}]+(\d+)\.")
    section = r"^#{2,4}\s+(\d+)\.(\d+)(?:\.(\d+))?\.\s+"
    toc = F.regexp_replace(line, r"^\s+|\s+$", "").isin("ОГЛАВЛЕНИЕ", "Оглавление")
    rows = rows.withColumns({"toc": toc, "toc_seen": F.sum(toc.cast("int")).over(w), "pref": line.rlike(r"(?iu)^#\s+Предисловие"), "ch": chapter, "ap": appendix, "s1": number(section), "s2": number(section, 2), "s3": number(section, 3)})
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    mark = F.when(F.col("ch").isNotNull(), F.concat(F.lit("ch-"), F.when(F.col("ch") < 100, pad(F.col("ch"))).otherwise(F.col("ch").cast("string")))).when(F.col("ap").isNotNull(), F.concat(F.lit("ap-"), F.when(F.col("ap") < 100, pad(F.col("ap"))).otherwise(F.col("ap").cast("string"))))
    scope = F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit("unscoped"))
    kind = (
        F.when(F.col("toc") & (F.col("toc_seen") == 1), "original_toc").when(F.col("pref"), "preface").when(F.col("ch").isNotNull(), "chapter").when(F.col("ap").isNotNull(), "appendix")
        .when(F.col("s3").isNotNull(), "subsection").when(F.col("s1").isNotNull(), "section")
    )
    name = (
        F.when(F.col("kind") == "original_toc", "toc").when(F.col("kind") == "preface", "preface").when(F.col("kind").isin("chapter", "appendix"), mark)
        .when(F.col("kind") == "section", F.concat(scope, F.lit("-s"), pad(F.col("s1")), F.lit("-"), pad(F.col("s2"))))
        .when(F.col("kind") == "subsection", F.concat(scope, F.lit("-s"), pad(F.col("s1")), F.lit("-"), pad(F.col("s2")), F.lit("-"), pad(F.col("s3"))))
    )
    rows = rows.withColumn("kind", kind).withColumn("unit_id", name).withColumn("title", F.when(F.col("kind").isNotNull(), bare))
    rows = rows.withColumn("run_no", F.sum(F.col("kind").isNotNull().cast("int")).over(w))
    whole = rows.groupBy(key, F.col("run_no").alias("unit_no")).agg(
        F.max("kind").alias("kind"), F.max("unit_id").alias("unit_id"), F.max("title").alias("title"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "").alias("raw")
    )
    whole = whole.withColumns({"kind": F.coalesce("kind", F.lit("front")), "unit_id": F.coalesce("unit_id", F.lit("front")), "title": F.coalesce("title", F.lit("front matter"))})
    return whole.withColumn("path", paths.unit_path(F.col("kind"), F.col("unit_id")))


def split_by_headings(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """key, section_no, title and text: sections that first and second headings begin; text before them is titled text."""
    rows = lines(docs, key, body)
    begins = F.col("line").rlike(r"^#{1,2} \S").cast("int")
    rows = rows.withColumn("run_no", F.sum(begins).over(Window.partitionBy(key).orderBy("line_no")))  # the lines of one text
    title = F.regexp_replace(F.min_by("line", "line_no"), r"^#{1,2} ", "")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    out = rows.groupBy(key, F.col("run_no").alias("section_no")).agg(F.when(F.first("run_no") == 0, "text").otherwise(F.trim(title)).alias("title"), joined.alias("text"))
    return out.where((F.col("section_no") > 0) | (F.trim(F.regexp_replace("text", r"\s", "")) != ""))


FOOTNOTE = r"(?ms)^(\[\^(\d+)\]:.*?)(?=^\[\^\d+\]:|\z)"


def footnotes(docs: DataFrame, key: str = "doc_id", body: str = "text") -> tuple[DataFrame, DataFrame]:
    """Definitions (key, n, pos, definition) and references (key, n, pos) of footnotes, in order."""
    defs = docs.select(key, F.posexplode(F.arrays_zip(F.regexp_extract_all(body, F.lit(FOOTNOTE), 2).alias("n"), F.regexp_extract_all(body, F.lit(FOOTNOTE), 1).alias("d"))).alias("pos", "z"))
    refs = docs.select(key, F.posexplode(F.regexp_extract_all(F.regexp_replace(body, FOOTNOTE, ""), F.lit(r"\[\^(\d+)\]"), 1)).alias("pos", "n"))
    return defs.select(key, F.col("z.n").cast("int").alias("n"), "pos", F.regexp_replace("z.d", r"\s+\z", "").alias("definition")), refs.select(key, F.col("n").cast("int").alias("n"), "pos")


def footnote_findings(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """severity, rule, entity_key and detail of notes undefined, unused, defined or called twice."""
    defs, refs = footnotes(docs, key, body)
    found = lambda df, severity, rule: df.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), F.col(key).cast("string").alias("entity_key"), F.col("n").cast("string").alias("detail"))
    out = found(refs.select(key, "n").distinct().join(defs, [key, "n"], "left_anti"), "block", "undefined_footnote")
    out = out.union(found(defs.select(key, "n").distinct().join(refs, [key, "n"], "left_anti"), "note", "unowned_footnote"))
    for df, rule in ((defs, "duplicate_definition"), (refs, "repeated_reference")):
        out = out.union(found(df.groupBy(key, "n").count().where("count > 1"), "block", rule))
    return out


def replicate_footnotes(parts: DataFrame, work: str, part: str, order: str, body: str = "text") -> DataFrame:
    """parts with the definitions that a part calls but another part of its work holds (the first by order) put behind it."""
    defs, refs = footnotes(parts.select(work, part, order, body, F.struct(work, part, order).alias("_k")), "_k", body)
    first = defs.groupBy(F.col(f"_k.{work}").alias("_w"), "n").agg(F.min_by("definition", F.struct(F.col(f"_k.{order}"), "pos")).alias("definition"))
    missing = refs.select("_k", "n").distinct().join(defs.select("_k", "n"), ["_k", "n"], "left_anti").withColumn("_w", F.col(f"_k.{work}"))
    added = missing.join(first, ["_w", "n"]).groupBy("_k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "definition"))), lambda x: x["definition"]), "\n").alias("_added"), F.count(F.lit(1)).alias("replicated"))
    keyed = parts.withColumn("_k", F.struct(work, part, order)).join(added, "_k", "left")
    return keyed.withColumn(body, F.when(F.col("_added").isNotNull(), F.concat(F.rtrim(body), F.lit("\n\n"), "_added", F.lit("\n"))).otherwise(F.col(body))).withColumn("replicated", F.coalesce("replicated", F.lit(0))).drop("_k", "_added")


def navigation(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """rows with previous and next value."""
    return ranges.neighbours(rows, key, order, value)


def repair_parent_pages(rows: DataFrame, key: str, order: str, within: int = 6) -> DataFrame:
    """page of a heading-only parent: the first later page found by context before the next parent, if within so many pages."""
    runs = ranges.running_sum(rows.withColumn("_key", F.struct(key)), key, order, F.col("is_parent").cast("int"), "_run")
    by_context = F.when((F.col("status") == "context") & ~F.col("is_parent"), F.col(order))
    child = runs.groupBy("_key", "_run").agg(F.min_by("page", by_context).alias("_child")).where("_child IS NOT NULL AND _run > 0")
    runs = runs.join(child, ["_key", "_run"], "left")
    fixed_page = F.when(F.col("is_parent") & (F.col("status") == "heading_only") & F.col("_child").between(F.col("page"), F.col("page") + within), F.col("_child")).otherwise(F.col("page"))
    return runs.withColumn("page", fixed_page).drop("_key", "_run", "_child")


def union_schemas(old: DataFrame, new: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rows of the old schema, renamed, and of the new one, with what either lacks as null."""
    return old.withColumnsRenamed(renames).unionByName(new, allowMissingColumns=True)


#: Headings of a block of the scan over a work.
PAGE_BLOCK = 128


def _assigned(heads: list[tuple[list[int], list[int]]], last: int, first: int) -> tuple[list[tuple[int | None, bool]], int]:
    """The page of each heading, and whether by context, if last is the last match before them; and the last match behind them."""
    out = []
    for pages, good in heads:
        low = max(first, last - 2)
        found, within = good, bisect_left(good, low) < len(good)
        if not within:
            found = pages
        at = bisect_left(found, low)
        page = found[at] if at < len(found) else None
        out.append((page, within))
        last = last if page is None else max(last, page)
    return out, last


def _page_scan(heads: DataFrame, work: str, order: str, first: int) -> DataFrame:
    """work, order, page and within of heads (work, order, hits: array of page and within, in order of pages)."""
    pages = F.transform("hits", lambda h: h["page"])
    good = F.transform(F.filter("hits", lambda h: h["within"]), lambda h: h["page"])
    return _scanned(heads.select(work, order, pages.alias("pages"), good.alias("good")), work, order, first)


def _scanned(heads: DataFrame, work: str, order: str, first: int) -> DataFrame:
    """work, order, page and within of heads (work, order, pages and those of them by context, good: sorted arrays).

    What a block of headings makes of the last match before it is a function with a step for each of its pages, found for all blocks
    at once; the matches between blocks take a row a block, read one after the other; then each block is gone through with its own.
    """
    places = ranges.numbered(heads.select(work, order), work, order, "_pos").withColumn("_block", F.floor((F.col("_pos") - 1) / PAGE_BLOCK).cast("int"))
    rows = places.select(F.struct(work).alias("_k"), order, "_pos", "_block").join(heads.select(F.struct(work).alias("_k"), order, "pages", "good"), ["_k", order])
    blocks = rows.groupBy("_k", "_block").agg(F.array_sort(F.collect_list(F.struct("_pos", F.col(order).alias("at"), "pages", "good"))).alias("heads")).persist()
    key = blocks.schema["_k"].dataType.simpleString()
    found = blocks.schema["heads"].dataType.simpleString()

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto, most = [], []
            for block in batch.column("heads"):
                hits = [(h["pages"], h["good"]) for h in block.as_py()]
                # a page counts up to a last match two pages behind it: between two such places nothing changes
                places = sorted({page + 2 for pages, _ in hits for page in pages}) + [1 << 30]
                upto.append(places)
                most.append([max((p for p, _ in _assigned(hits, at, first)[0] if p is not None), default=0) for at in places])
            yield pa.RecordBatch.from_arrays([batch.column("_k"), batch.column("_block"), pa.array(upto, pa.list_(pa.int32())), pa.array(most, pa.list_(pa.int32()))], names=["_k", "_block", "upto", "most"])

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, last = None, first + 1
        for batch in batches:
            before = []
            for k, upto, most in zip(*(batch.column(c).to_pylist() for c in ("_k", "upto", "most"))):
                if k != of:
                    of, last = k, first + 1
                before.append(last)
                last = max(last, most[bisect_left(upto, last)])
            yield pa.RecordBatch.from_arrays([batch.column("_k"), batch.column("_block"), pa.array(before, pa.int32())], names=["_k", "_block", "last"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, within, sizes = [], [], []
            for block, last in zip(batch.column("heads"), batch.column("last").to_pylist()):
                got, _ = _assigned([(h["pages"], h["good"]) for h in block.as_py()], last, first)
                pages += [p for p, _ in got]
                within += [w for _, w in got]
                sizes.append(len(got))
            which = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            at = pa.compute.struct_field(pa.compute.list_flatten(batch.column("heads")), "at")
            yield pa.RecordBatch.from_arrays([batch.column("_k").take(which), at, pa.array(pages, pa.int32()), pa.array(within, pa.bool_())], names=["_k", "at", "page", "within"])

    n = int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    passed = blocks.mapInArrow(steps, f"_k {key}, _block int, upto array<int>, most array<int>").repartition(n, "_k").sortWithinPartitions("_k", "_block")
    passed = passed.mapInArrow(carry, f"_k {key}, _block int, last int")
    kind = heads.schema[order].dataType.simpleString()
    settled = blocks.join(passed, ["_k", "_block"]).select("_k", F.col("heads").cast(found).alias("heads"), "last").mapInArrow(settle, f"_k {key}, at {kind}, page int, within boolean")
    return settled.select(F.col(f"_k.{work}").alias(work), F.col("at").alias(order), "page", "within")


def page_candidates(headings: DataFrame, pages: DataFrame, work: str, order: str, first: int = 4, least: int = 8, cut: int = 95) -> DataFrame:
    """work, order, page and status of every heading in the pages of its work.

    headings: work, order, kind, title (normalised) and contexts (array of normalised starts of its paragraphs); pages: work, page (from 1), text
    (normalised). A heading's page is the first that holds its title (cut characters of it) and one of whose contexts stands there or on the
    next page, else the first that holds it; pages before first, and those more than two before the last match, do not count. Titles are
    sought by windows of their bytes; the last match goes from block to block of a work's headings. Headings of one work and order are one.
    """
    asked = headings.where(F.col("kind").isin("chapter", "appendix", "section", "subsection", "preface") & (F.length("title") >= least))
    asked = asked.select(work, order, F.substring("title", 1, cut).alias("_name"), "contexts")
    # headings of one title and the same contexts are found once
    alike = asked.groupBy(work, "_name", "contexts").agg(F.min(order).alias("_least"))
    named = alike.select(F.struct(work, "_least").alias("_head"), work, F.array("_name").alias("words"))
    # a page with the next one: pairs of a heading and a page go to it, so that no text is dealt out for each of them
    page = F.struct(F.col(work).alias("work"), F.col("page").cast("int").alias("page")).alias("_page")
    after = pages.select(F.struct(F.col(work).alias("work"), (F.col("page") - 1).cast("int").alias("page")).alias("_page"), F.col("text").alias("_next"))
    keyed = pages.select(page, work, "text")
    pairs = grams.candidates(keyed, "_page", "text", named, "_head", within=work).distinct()
    pairs = pairs.join(alike.select(F.struct(work, "_least").alias("_head"), "_name", "contexts"), "_head")
    met = keyed.select("_page", "text").join(after, "_page", "left").join(pairs, "_page").where(F.contains("text", "_name"))
    within = F.coalesce(F.exists("contexts", lambda c: F.col("text").contains(c) | F.coalesce(F.col("_next").contains(c), F.lit(False))), F.lit(False))
    met = met.select("_head", "_page.page", within.alias("within"))
    listed = lambda c: F.array_sort(F.collect_set(c))
    hits = met.groupBy("_head").agg(listed(F.col("page")).alias("pages"), listed(F.when(F.col("within"), F.col("page"))).alias("good"))
    heads = asked.join(alike.withColumnsRenamed({"_name": "_n", "contexts": "_c", work: "_w"}), (F.col(work) == F.col("_w")) & (F.col("_name") == F.col("_n")) & F.col("contexts").eqNullSafe(F.col("_c")))
    # headings of one work and order are one, which has the pages of all
    heads = heads.select(work, order, F.struct(work, "_least").alias("_head")).join(hits, "_head").groupBy(work, order).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("good")))).alias("good")).persist()
    found = _scanned(heads, work, order, first).select(F.col(work).alias("_w"), F.col(order).alias("_at"), "page", "within")
    rows = headings.select(work, order, "kind", F.length("title").alias("_n")).join(found, (F.col(work) == F.col("_w")) & (F.col(order) == F.col("_at")), "left")
    status = (
        F.when(~F.col("kind").isin("chapter", "appendix", "section", "subsection", "preface"), "not_applicable").when(F.col("_n") < least, "title_too_short")
        .when(F.col("page").isNull(), "not_found").when(F.col("within"), "auto_heading_plus_context_candidate").otherwise("auto_heading_only_candidate")
    )
    return rows.select(work, order, "page", status.alias("status"))
