"""Volumes and their media: contexts, openings, references that may not ship, quality records and release manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from .sections import multiset_difference
from .semantic import finding, together


def line_context(body: Column, paragraphs: int = 14, least: int = 58, keep: int = 5, chars: int = 95) -> Column:
    """Beginnings of the first paragraphs behind the heading that are long enough, as letters and digits only."""
    later = F.slice(F.split(body, r"\n\s*\n"), 2, paragraphs)
    bare = F.transform(later, lambda p: F.regexp_replace(F.lower(text.detag(p)), r"[^\p{L}\p{N}]", ""))
    return F.transform(F.slice(F.filter(bare, lambda p: F.length(p) >= least), 1, keep), lambda p: F.substring(p, 1, chars))


def line_index(files: DataFrame, key: str = "path", body: str = "text") -> DataFrame:
    """key, line_no, norm of every line that is not blank: what anchors are sought in."""
    rows = files.select(key, F.posexplode(F.split(body, "\n")).alias("line_no", "line"))
    return rows.withColumn("norm", text.squeeze(F.col("line"))).where("norm <> ''").select(key, "line_no", "norm")


def opening_section(sections: DataFrame, work: str = "work_id", order: str = "reading_order", kinds: tuple[str, ...] = ("opening", "front")) -> DataFrame:
    """work and path of its opening: the first section of such a kind, else the first."""
    named = F.when(F.col("kind").isin(*kinds), F.col(order))
    return sections.groupBy(work).agg(F.coalesce(F.min_by("path", named), F.min_by("path", order)).alias("path"))


def target_name(name: Column, staged: Column) -> Column:
    """The file name to ship: the own stem with the staged file's extension, where that changed."""
    ext = lambda c: F.lower(F.regexp_extract(c, r"(\.[^./]*)$", 1))
    return F.when(ext(name) == ext(staged), name).otherwise(F.concat(F.regexp_replace(name, r"\.[^./]*$", ""), ext(staged)))


def with_defaults(records: DataFrame, defaults: dict) -> DataFrame:
    """records with the columns of defaults, null or absent ones filled."""
    have = set(records.columns)
    return records.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in have else F.lit(v) for k, v in defaults.items()})


def work_root(work: Column, volume_pattern: str = r"^tom-", volumes: str = "", works: str = "works/") -> Column:
    return F.when(work.rlike(volume_pattern), F.concat(F.lit(volumes), work)).otherwise(F.concat(F.lit(works), work))


def source_note(title: Column, edition: Column, date: Column, url: Column) -> Column:
    """A line that says where a text is from, of the parts there are."""
    part = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(label), c))
    return F.concat_ws("; ", part("", title), part("edition: ", edition), part("date: ", date), part("source: ", url))


def topic_labels(concepts: DataFrame, topics: DataFrame, published: DataFrame) -> DataFrame:
    """concept_id with the labels of its topics in their order, and its related concepts that are published."""
    linked = concepts.select("concept_id", F.explode("related_topic_ids").alias("topic_id")).join(topics.select("topic_id", "priority", "label"), "topic_id")
    labels = linked.groupBy("concept_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("priority", "label"))), lambda x: x["label"]).alias("topics"))
    related = concepts.select("concept_id", F.posexplode("related_concept_ids").alias("pos", "other")).join(published.select(F.col("concept_id").alias("other")), "other", "left_semi")
    names = related.groupBy("concept_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "other"))), lambda x: x["other"]).alias("related"))
    empty = F.array().cast("array<string>")
    return concepts.select("concept_id").join(labels, "concept_id", "left").join(names, "concept_id", "left").select("concept_id", F.coalesce("topics", empty).alias("topics"), F.coalesce("related", empty).alias("related"))


def blocked_references(references: DataFrame, records: DataFrame) -> DataFrame:
    """references (work_id, file) whose records, by shipped or original name, are all blocked."""
    names = records.select("work_id", F.col("media_file").alias("file"), "figure_id", "is_blocked").union(records.select("work_id", F.col("original_filename").alias("file"), "figure_id", "is_blocked")).where("file IS NOT NULL").distinct()
    return references.join(names, ["work_id", "file"]).groupBy("work_id", "file").agg(F.every("is_blocked").alias("all_blocked")).where("all_blocked").drop("all_blocked")


def figure_counts(records: DataFrame) -> DataFrame:
    """dimension, name and n: figures by status, provenance class and anchor confidence; what is unknown is not counted."""
    one = lambda c: records.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("dimension"), "name", "n")
    return together([one(c) for c in ("publication_status", "provenance_class", "anchor_confidence") if c in records.columns])


def quality_record(sections: DataFrame, chunks: DataFrame, footnotes: DataFrame) -> DataFrame:
    """One row a volume: sections, chunks, characters and footnotes, and whether chunks keep all characters."""
    a = sections.groupBy("volume").agg(F.count(F.lit(1)).alias("n_sections"), F.sum(F.length("text")).alias("n_chars"))
    b = chunks.join(sections.select("section_id", "volume"), "section_id").groupBy("volume").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("text")).alias("_chars"))
    c = footnotes.groupBy("volume").agg(F.count(F.lit(1)).alias("n_footnotes"))
    rows = a.join(b, "volume", "left").join(c, "volume", "left")
    return rows.select("volume", "n_sections", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), "n_chars", F.coalesce("n_footnotes", F.lit(0)).alias("n_footnotes"), F.coalesce(F.col("_chars") == F.col("n_chars"), F.lit(False)).alias("is_lossless"))


def suggested(items: DataFrame, key: str, order: str, path: str = "suggested_path") -> DataFrame:
    """Of each key the first item that has a path, else the first."""
    columns = F.struct(*[c for c in items.columns if c != key])
    best = F.coalesce(F.min_by(columns, F.when(F.col(path).isNotNull(), F.col(order))), F.min_by(columns, order))
    return items.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def tree_digest(files: DataFrame, levels: tuple[int, ...] = (4, 2, 0)) -> DataFrame:
    """volume and tree_sha256 of files (volume, path, sha256), whatever their order and partitions.

    A file is a leaf at the first digits of its path's hash; a node is the hash of its leaves' paths and hashes, or of its children's digits and
    hashes, in order, a line each. So no value holds more than the part of a volume below one node, and a changed file changes the nodes above it.
    """
    place = lambda c, n: F.substring(c, 1, n)
    node = lambda: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "sha256"))), lambda x: F.concat(x["name"], F.lit(" "), x["sha256"])), "\n"), 256)
    rows = files.select("volume", F.sha2("path", 256).alias("at"), F.col("path").alias("name"), "sha256")
    for n in levels:
        rows = rows.groupBy("volume", place(F.col("at"), n).alias("at")).agg(node().alias("sha256")).select("volume", "at", F.col("at").alias("name"), "sha256")
    return rows.select("volume", F.col("sha256").alias("tree_sha256"))


def release_manifest(files: DataFrame, queue: DataFrame, excluded: list[str]) -> DataFrame:
    """volume, n_files, bytes, n_excluded, n_verified and n_pending, and tree_sha256 of the files that are not excluded if files have hashes.

    files: volume, path, bytes, and perhaps sha256; queue: volume, human_review_status.
    """
    out = F.col("path").rlike("|".join(excluded)) if excluded else F.lit(False)
    a = files.groupBy("volume").agg(F.count_if(~out).alias("n_files"), F.sum(F.when(~out, F.col("bytes")).otherwise(0)).alias("bytes"), F.count_if(out).alias("n_excluded"))
    b = queue.groupBy("volume").agg(F.count_if(F.col("human_review_status") == "verified").alias("n_verified"), F.count_if(~F.col("human_review_status").eqNullSafe(F.lit("verified"))).alias("n_pending"))
    rows = a.join(b, "volume", "left").na.fill(0, ["n_verified", "n_pending"])
    return rows.join(tree_digest(files.where(~out)), "volume", "left") if "sha256" in files.columns else rows


def old_volume_findings(units: DataFrame, chunks: DataFrame, footnotes: DataFrame, pins: DataFrame) -> DataFrame:
    """Findings of the older schema.

    units: id, text, source_text_hash, source_sha256, pdf_page_start, pdf_page_end_inclusive, footnote_numbers; chunks: chunk_id, unit_id,
    start_char_in_unit, end_char_in_unit, text; footnotes: n, owner; pins: the accepted source_sha256.
    """
    placed = chunks.join(units.select(F.col("id").alias("unit_id"), F.col("text").alias("_unit")), "unit_id", "left")
    cut = F.expr("substring(_unit, start_char_in_unit + 1, end_char_in_unit - start_char_in_unit)")
    called = units.select("id", F.explode("footnote_numbers").alias("n")).withColumn("n", F.col("n").cast("string"))
    known = footnotes.select(F.col("n").cast("string").alias("n"), "owner")
    covered = chunks.groupBy("unit_id").agg(F.sum(F.length("text")).alias("_chars"))
    return together(
        [
            finding(units.groupBy("id").count().where("count > 1"), "duplicate_unit_id", F.col("id"), F.col("count")),
            finding(units.where("sha2(text, 256) <> source_text_hash"), "text_hash_mismatch", F.col("id"), ""),
            finding(units.join(pins, "source_sha256", "left_anti"), "source_not_pinned", F.col("id"), F.col("source_sha256")),
            finding(units.where("pdf_page_end_inclusive < pdf_page_start OR pdf_page_start < 1"), "page_range", F.col("id"), F.col("pdf_page_start")),
            finding(placed.where("_unit IS NULL"), "orphan_chunk", F.col("chunk_id"), F.col("unit_id")),
            finding(placed.where(cut != F.col("text")), "chunk_is_not_its_range", F.col("chunk_id"), F.col("unit_id")),
            finding(units.join(covered, F.col("id") == F.col("unit_id"), "left").where("length(text) <> coalesce(_chars, 0)"), "chunks_lose_text", F.col("id"), ""),
            finding(called.join(known, "n", "left_anti"), "undefined_footnote", F.col("id"), F.col("n")),
            finding(known.join(called.select("n"), "n", "left_anti"), "unowned_footnote", F.col("n"), F.col("owner")),
            finding(known.groupBy("n").count().where("count > 1"), "duplicate_footnote", F.col("n"), F.col("count")),
        ]
    )


def volume_findings(sections: DataFrame, chunks: DataFrame, notes: DataFrame, pages: DataFrame, media: DataFrame, figures: DataFrame, anchors: DataFrame) -> DataFrame:
    """Findings of a volume beyond audit.section_findings(): bodies, notes, pages and media.

    sections: section_id, path, text, page, footnote_numbers (array); chunks: section_id, chunk_no, page; notes: n, definition;
    pages: path, body (the published Markdown without its leading block), page (of that block); media: name (of files); figures: media_name;
    anchors: image, preview_path (null for none) and has_preview (whether that file is there).
    """
    known = notes.select(F.col("n").cast("string").alias("n"), "definition")
    called = sections.select("section_id", F.posexplode("footnote_numbers").alias("pos", "n")).withColumn("n", F.col("n").cast("string"))
    once = known.groupBy("n").agg(F.first("definition").alias("definition"))
    cited = called.join(once, "n", "left").groupBy("section_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("definition").isNotNull(), F.struct("pos", "definition")))), lambda x: x["definition"]), "\n\n").alias("_notes"))
    rows = sections.join(cited, "section_id", "left").join(pages.select("path", F.col("body").alias("_body"), F.col("page").alias("_page"), F.lit(True).alias("_there")), "path", "left")
    behind = F.when(F.coalesce("_notes", F.lit("")) != "", F.concat(F.lit("\n"), "_notes", F.lit("\n"))).otherwise("")
    expected = F.concat(F.regexp_replace("text", r"\s+\z", ""), F.lit("\n"), behind)
    local = pages.select("path", F.explode(F.regexp_extract_all("body", F.lit(fixed.MARKDOWN_IMAGE), 1)).alias("link")).where(~F.col("link").rlike("^(?:https?://|data:)"))
    local = local.withColumn("_name", F.substring_index(F.regexp_replace("link", "#.*$", ""), "/", -1))
    held = media.select(F.col("name").alias("_name")).distinct()
    lost = lambda df, column, rule: finding(df.select(F.col(column).alias("_name")).distinct().join(held, "_name", "left_anti"), rule, F.col("_name"), "")
    shown = figures.select(F.col("media_name").alias("_name")).union(anchors.select(F.col("image").alias("_name"))).distinct()
    uneven = multiset_difference(called.select("n"), known.select("n"), "n")
    off = chunks.join(sections.select("section_id", F.col("page").alias("_page")), "section_id").where("NOT (page <=> _page)")
    return together(
        [
            finding(rows.where("_there IS NULL"), "missing_section_file", F.col("section_id"), F.col("path")),
            finding(rows.where("_there AND NOT (_page <=> page)"), "page_metadata_mismatch", F.col("section_id"), F.col("path")),
            finding(rows.where(F.col("_there") & (text.media_marks(F.col("_body")) != text.media_marks(expected))), "body_diverges_from_text", F.col("section_id"), F.col("path")),
            finding(off, "chunk_page_mismatch", F.col("section_id"), F.col("chunk_no")),
            finding(called.join(once, "n", "left_anti"), "missing_note_definition", F.col("section_id"), F.col("n")),
            finding(known.groupBy("n").count().where("count > 1"), "duplicate_note_definition", F.col("n"), F.col("count")),
            finding(uneven, "footnote_lost_or_repeated", F.col("n"), F.concat_ws("/", F.col("n_left").cast("string"), F.col("n_right").cast("string"))),
            finding(local.join(held, "_name", "left_anti"), "missing_local_image", F.col("path"), F.col("link")),
            lost(figures, "media_name", "figure_media_missing"),
            lost(anchors, "image", "anchor_media_missing"),
            finding(anchors.where("preview_path IS NOT NULL AND NOT has_preview"), "anchor_preview_missing", F.col("image"), F.col("preview_path")),
            finding(held.join(shown, "_name", "left_anti"), "media_without_anchor", F.col("_name"), "", "note"),
        ]
    )
