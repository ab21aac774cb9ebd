"""The search index and ranked search over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from . import grams


def index(sections: DataFrame) -> DataFrame:
    """title, kind, work_id, section_id, url and the first characters of text of section_id, work_id, title, body."""
    url = F.concat(F.lit("/"), "work_id", F.lit("/"), F.col("section_id").cast("string"), F.lit(".html"))
    return sections.select("title", F.lit("section").alias("kind"), "work_id", "section_id", url.alias("url"), F.substring("body", 1, fixed.SEARCH_TEXT_CHARS).alias("text"))


def concept_rows(concepts: DataFrame) -> DataFrame:
    """Published concepts (concept_id, canonical_term, aliases, definition) as rows of the index: work_id and section_id are null, aliases lead the text."""
    words = F.concat_ws(" ", F.array_join(F.coalesce("aliases", F.array().cast("array<string>")), " "), F.coalesce("definition", F.lit("")))
    url = F.concat(F.lit("/concepts/"), "concept_id", F.lit(".html"))
    none = F.lit(None)
    return concepts.select(F.col("canonical_term").alias("title"), F.lit("concept").alias("kind"), none.cast("string").alias("work_id"), none.cast("bigint").alias("section_id"), url.alias("url"), F.substring(F.trim(words), 1, fixed.SEARCH_TEXT_CHARS).alias("text"))


def full_index(sections: DataFrame, concepts: DataFrame) -> DataFrame:
    """index() of the sections and the rows of published concepts."""
    return index(sections).unionByName(concept_rows(concepts))


def search(rows: DataFrame, query: str, limit: int = fixed.SEARCH_LIMIT, title: str = "title", body: str = "text", order: str = "section_id") -> DataFrame:
    """Rows that hold every word of the query in title or text, with score (10 for a word in the title, else 1) and snippet; the best first, ties in order."""
    words = [w for w in query.strip().lower().split() if w]
    if not words:
        return rows.limit(0).withColumn("score", F.lit(0)).withColumn("snippet", F.lit(""))
    head = F.lower(F.coalesce(title, F.lit("")))
    hay = F.concat_ws(" ", head, F.lower(F.coalesce(body, F.lit(""))))
    matched, score = F.lit(True), F.lit(0)
    for w in words:
        matched = matched & hay.contains(w)
        score = score + F.when(head.contains(w), 10).otherwise(1)
    found = rows.where(matched).withColumn("score", score.cast("int")).withColumn("snippet", F.substring(body, 1, fixed.SNIPPET_CHARS))
    return found.orderBy(F.desc("score"), order).limit(limit)


def search_all(rows: DataFrame, queries: DataFrame, limit: int = fixed.SEARCH_LIMIT, order: str = "section_id") -> DataFrame:
    """search() for a table of queries (query_id, query), however many: query_id, rank, order and score. Rows of one order are found each."""
    asked = queries.withColumn("words", F.filter(F.split(F.lower(F.trim("query")), r"\s+"), lambda w: w != "")).where(F.size("words") > 0).select("query_id", "words")
    heads = rows.select(order, F.lower(F.coalesce("title", F.lit(""))).alias("_head"), F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")))).alias("_body"))
    pairs = grams.candidates(heads, order, "_body", asked, "query_id").distinct()
    met = pairs.join(asked, "query_id").join(heads, order).where(F.forall("words", lambda w: F.contains(F.col("_body"), w)))
    score = F.aggregate("words", F.lit(0), lambda a, w: a + F.when(F.contains(F.col("_head"), w), 10).otherwise(1))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), order))
    return met.withColumn("score", score).withColumn("rank", rank).where(F.col("rank") <= limit).select("query_id", "rank", order, "score")
