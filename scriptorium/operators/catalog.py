"""Catalogues: works, chronologies, languages, translations and their ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text


def work_catalog(sections: DataFrame) -> DataFrame:
    """work_id, n_sections, n_chars and the hash of all its section ids in order."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("section_id")), lambda i: i.cast("string")), ",")
    return sections.groupBy("work_id").agg(F.count(F.lit(1)).alias("n_sections"), F.sum(F.length("body")).alias("n_chars"), F.sha2(ids, 256).alias("sections_sha"))


def chronology(works: DataFrame) -> DataFrame:
    """year, title and place of works (date, year, title), by year as text, then title; unknown years last.

    Places are counted within a year and set off by the years before, of which there are few: no task sorts all works.
    """
    rows = works.select(text.year(F.col("date"), F.col("year")).alias("year"), "title")
    years = rows.groupBy("year").agg(F.count(F.lit(1)).alias("_n"))
    before = years.select("year", F.coalesce(F.sum("_n").over(Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = rows.withColumn("_own", F.row_number().over(Window.partitionBy("year").orderBy("title")))
    return placed.join(before, "year").select("year", "title", (F.col("_before") + F.col("_own")).alias("place"))


def by_collection(works: DataFrame) -> DataFrame:
    """collection and its titles by date, then title."""
    item = F.struct(F.coalesce("date", F.lit("")).alias("date"), "title")
    return works.groupBy("collection").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["title"]).alias("titles"))


def languages(translations: DataFrame, language: str = "language") -> DataFrame:
    """language and n, the most frequent first, then by name."""
    return translations.groupBy(language).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), language)


def ledger(rows: DataFrame, url: str, order: str) -> DataFrame:
    """rows with item_id: the slug of the url, with -2, -3 and so on where it was taken before."""
    named = rows.withColumn("_slug", text.slug(F.col(url)))
    n = F.row_number().over(Window.partitionBy("_slug").orderBy(order))
    return named.withColumn("item_id", F.when(n == 1, F.col("_slug")).otherwise(F.concat("_slug", F.lit("-"), n.cast("string")))).drop("_slug")


def translation_ids(rows: DataFrame, url: str, language: str, order: str) -> DataFrame:
    """rows with translation_id: the ledger's item id behind the language, unless it begins with it; other than word characters and hyphens as hyphens."""
    named = ledger(rows, url, order)
    own = F.startswith("item_id", F.concat(F.col(language), F.lit("_")))
    whole = F.when(own, F.replace("item_id", F.lit("_"), F.lit("-"))).otherwise(F.concat(F.col(language), F.lit("-"), "item_id"))
    return named.withColumn("translation_id", F.regexp_replace(whole, r"[^\p{L}\p{N}_-]+", "-")).drop("item_id")


def translation_status(text_chars: Column, has_file: Column, failed: Column, least: int = fixed.FULL_TEXT_LEAST_WORD_CHARS) -> Column:
    """full, text_unavailable, download_failed or no_source_file; text_chars: word characters of the converted text, null if it could not be converted."""
    return F.when(~has_file, F.when(failed, "download_failed").otherwise("no_source_file")).when(F.coalesce(text_chars, F.lit(0)) < least, "text_unavailable").otherwise("full")


def split_sections(body: Column) -> Column:
    """array<struct<n, file, title, content>> of a Markdown text: what headings of the first two levels begin, and text before them, titled text.

    content is what the file of the section holds: its heading as one of the second level, a blank line and its text.
    """
    strip = lambda c: F.regexp_replace(c, rf"^{text.SPACES}|{text.SPACES}$", "")
    parts = F.split(F.regexp_replace(body, r"(?md)^(#{1,2}\s)", "\x01$1"), "\x01")
    heading = r"(?s)^#{1,2}\s+([^\n]*)"
    told = F.transform(parts, lambda p: F.struct(
        F.when(p.rlike(r"^#{1,2}\s"), strip(F.regexp_extract(p, heading, 1))).otherwise("text").alias("title"), strip(F.regexp_replace(p, heading, "")).alias("body")))
    # text before the first heading counts only if there is some; a text without anything is one section
    kept = F.filter(told, lambda x, i: (i > 0) | (x["body"] != "") | (F.size(parts) == 1))
    number = lambda i: F.when(i < 9, F.lpad((i + 1).cast("string"), 2, "0")).otherwise((i + 1).cast("string"))
    content = lambda x: F.concat(F.when(x["title"] == "text", x["body"]).otherwise(F.concat(F.lit("## "), x["title"], F.lit("\n\n"), x["body"])), F.lit("\n"))
    return F.transform(kept, lambda x, i: F.struct((i + 1).cast("int").alias("n"), F.concat(number(i), F.lit(".md")).alias("file"), x["title"].alias("title"), content(x).alias("content")))


def enriched(rows: DataFrame, converted: DataFrame, key: str = "translation_id", least: int = fixed.FULL_TEXT_LEAST_WORD_CHARS, title_chars: int = 200) -> DataFrame:
    """rows (key, has_file, failed) with full_text_status, sections_count, reading_order, md_sha256 and conversion_error.

    converted: key, text (null if the source could not be converted) and error, of new conversions or those of an earlier run. The hash
    is that of all section files one after the other; a text that is too short has no sections, and says so.
    """
    made = converted.groupBy(key).agg(F.max(F.struct("text", "error")).alias("_c")).select(key, F.replace("_c.text", F.lit("\u00ad"), F.lit("")).alias("_text"), F.col("_c.error").alias("_error"))
    out = rows.join(made, key, "left")
    status = translation_status(F.when(F.col("_text").isNotNull(), text.word_chars(F.col("_text"))), F.col("has_file"), F.col("failed"), least)
    out = out.withColumn("full_text_status", status).withColumn("_sections", F.when(F.col("full_text_status") == "full", split_sections(F.col("_text"))))
    error = F.when(F.col("full_text_status") == "text_unavailable", F.when(F.col("_text").isNull(), F.substring(F.coalesce("_error", F.lit("not converted")), 1, 200)).otherwise("extracted text too short"))
    return out.withColumns({
        "sections_count": F.when(F.col("_sections").isNotNull(), F.size("_sections")), "conversion_error": error,
        "reading_order": F.transform("_sections", lambda x: F.struct(x["n"].alias("n"), x["file"].alias("file"), F.substring(x["title"], 1, title_chars).alias("title"))),
        "md_sha256": F.sha2(F.array_join(F.transform("_sections", lambda x: x["content"]), ""), 256),
    }).drop("_text", "_error", "_sections")


def section_files(rows: DataFrame, key: str = "translation_id", language: str = "language", body: str = "text") -> DataFrame:
    """path and text of the section files of rows: language, key and file, for the pages sink."""
    return rows.select(language, key, F.explode(split_sections(F.replace(body, F.lit("\u00ad"), F.lit("")))).alias("s")).select(F.concat_ws("/", language, key, "s.file").alias("path"), F.col("s.content").alias("text"))


def translation_totals(rows: DataFrame, by_match: bool = False) -> DataFrame:
    """n_entries, n_languages, n_full and n_cards of translations (language, is_full), of all or of each match."""
    grouped = rows.groupBy("match") if by_match else rows.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n_entries"), F.count_distinct("language").alias("n_languages"), F.count_if("is_full").alias("n_full"), F.count_if(~F.col("is_full")).alias("n_cards"))


def active_citations(citations: DataFrame) -> DataFrame:
    """Citation targets that are active and have a page."""
    return citations.where("status = 'active' AND coalesce(site_path, '') <> ''")


def section_citations(sections: DataFrame, citations: DataFrame, order: str, key: str = "section_id") -> DataFrame:
    """sections with citation_target_id and site_path of the last active citation by order that names them."""
    last = active_citations(citations).groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct("citation_target_id", "site_path"), order).alias("_c"))
    return sections.join(last, F.col(key) == F.col("_key"), "left").withColumns({"citation_target_id": F.col("_c.citation_target_id"), "site_path": F.col("_c.site_path")}).drop("_key", "_c")


def in_scope(rows: DataFrame, volumes: list, sections: list, ids: list) -> DataFrame:
    """rows whose volume, section_id or id the release's scope names: three short lists, so literals rather than joins."""
    named = lambda column, wanted: F.coalesce(F.col(column).isin(wanted), F.lit(False)) if wanted else F.lit(False)
    return rows.where(named("volume", volumes) | named("section_id", sections) | named("id", ids))


def action_groups(records: DataFrame, by: list[str], size: Column) -> DataFrame:
    """by, n and bytes of records that wait for the owner, the largest groups first."""
    open_ = records.where("publication_status NOT IN ('published', 'duplicate')")
    return open_.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(size).cast("bigint").alias("bytes")).orderBy(F.desc("n"), F.desc("bytes"))


def translations_of(works: DataFrame, translations: DataFrame) -> DataFrame:
    """work_id, translation_ids and n of works with translations (translation_id, work_id, related_work_ids)."""
    linked = translations.select("translation_id", F.explode(F.array_distinct(F.array_compact(F.concat(F.array("work_id"), F.coalesce("related_work_ids", F.array().cast("array<string>")))))).alias("work_id"))
    return linked.join(works.select("work_id"), "work_id").groupBy("work_id").agg(F.array_sort(F.collect_list("translation_id")).alias("translation_ids"), F.count(F.lit(1)).alias("n"))


def references(cards: DataFrame, accepted: list[str]) -> DataFrame:
    """group and cards of external references whose final status is accepted."""
    return cards.where(F.col("final_status").isin(accepted)).groupBy("group").agg(F.array_sort(F.collect_list("title")).alias("titles"), F.count(F.lit(1)).alias("n"))


def meta_only(status: Column, work_id: Column, statuses: list[str], ids: list[str]) -> Column:
    """Works of which only metadata may be shown."""
    return F.coalesce(status.isin(statuses), F.lit(False)) | work_id.isin(ids)
