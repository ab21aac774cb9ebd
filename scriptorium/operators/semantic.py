"""Topics, concepts, citations and language variants: membership, evidence and validation. A rule is a DataFrame of findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, media, text
from . import grams


def finding(df: DataFrame, rule: str, key: Column, detail: Column | str, severity: str = "block") -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), key.cast("string").alias("entity_key"), (F.lit(detail) if isinstance(detail, str) else detail.cast("string")).alias("detail"))


def together(found: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


#: Topics that one plan holds as conditions; more are met by postings of grams, with the same result.
TOPICS = 1000


def topic_members(topics: DataFrame, sections: DataFrame, title: str = "title", key: str = "section_id") -> DataFrame:
    """topic_id, key and title of every section whose normalised title holds a term; the topic of smallest priority wins.

    topics (topic_id, priority, terms) is an editorial list: up to TOPICS, every topic is one condition, so sections are read once, without a
    join; longer lists are joined with the sections by the grams of their terms.
    """
    kinds = sections.where("kind <> 'frontmatter'") if "kind" in sections.columns else sections
    listed = topics.orderBy("priority").limit(TOPICS + 1).collect()
    if len(listed) > TOPICS:
        return _members_of_many(topics, kinds, title, key)
    hay = text.norm_search(F.col(title))
    norm = lambda t: text.norm_search(F.lit(t))
    first = F.coalesce(*[F.when(reduce(Column.__or__, [F.contains(hay, norm(t)) for t in r["terms"]], F.lit(False)), F.lit(r["topic_id"])) for r in listed], F.lit(None).cast("string")) if listed else F.lit(None).cast("string")
    return kinds.withColumn("topic_id", first).where("topic_id IS NOT NULL").select("topic_id", key, title)


def _members_of_many(topics: DataFrame, sections: DataFrame, title: str, key: str) -> DataFrame:
    hays = sections.select(key, title, text.norm_search(F.col(title)).alias("_title"))
    terms = topics.select("topic_id", "priority", F.explode("terms").alias("_term")).withColumn("_term", text.norm_search(F.col("_term")))
    asked = terms.select(F.struct("priority", "topic_id", "_term").alias("_asked"), F.array("_term").alias("words")).distinct()
    pairs = grams.holding(hays, key, "_title", asked, "_asked").select(key, F.col("_asked._term").alias("_term"), F.struct("_asked.priority", "_asked.topic_id").alias("_topic"))
    # rows of one key may have other titles: each is judged by its own
    met = hays.join(pairs.distinct(), key).where(F.contains(F.col("_title"), F.col("_term")))
    return met.groupBy(key, title).agg(F.min("_topic").alias("_topic")).join(hays.select(key, title), [key, title]).select(F.col("_topic.topic_id").alias("topic_id"), key, title)


def topic_lists(members: DataFrame, order: str, limit: int = fixed.TOPIC_LIST_LIMIT) -> DataFrame:
    """The first members of each topic by order, with their place."""
    place = F.row_number().over(Window.partitionBy("topic_id").orderBy(order))
    return members.withColumn("place", place).where(F.col("place") <= limit)


def verified_evidence(concepts: DataFrame, sections: DataFrame) -> DataFrame:
    """concept_id, section_id, kind and term of evidence that the section's title or text bears out, by the term or any name of the concept."""
    given = concepts.select("concept_id", "canonical_term", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), F.explode("evidence").alias("e"))
    given = given.select("concept_id", F.col("e.section_id").alias("section_id"), F.col("e.kind").alias("kind"), F.col("e.term").alias("term"), F.concat(F.array(F.coalesce("e.term", "canonical_term"), F.col("canonical_term")), "aliases").alias("names"))
    hay = text.norm_search(F.when(F.col("kind") == "title", F.col("title")).otherwise(F.col("body")))
    met = given.join(sections.select("section_id", "title", "body"), "section_id").withColumn("hay", hay).withColumn("names", F.transform("names", text.norm_search))
    return met.where(F.exists("names", lambda n: F.contains(F.col("hay"), n))).select("concept_id", "section_id", "kind", "term")


def published_concepts(concepts: DataFrame, sections: DataFrame) -> DataFrame:
    """concept_id, n_evidence and is_published by the policy."""
    counts = verified_evidence(concepts, sections).groupBy("concept_id").agg(F.count(F.lit(1)).alias("n"))
    rows = concepts.join(counts, "concept_id", "left").withColumn("n_evidence", F.coalesce("n", F.lit(0)))
    allowed = media.indexable(F.lit("concept"), F.col("publication_state"), F.col("review_state"), F.lit(None).cast("string"), F.col("n_evidence") > 0)
    return rows.select("concept_id", "n_evidence", allowed.alias("is_published"))


def _missing(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    absent = F.filter(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in columns]), lambda c: c.isNotNull())
    return finding(df.withColumn("_c", F.explode(absent)), "missing_field", F.col(key), F.col("_c"))


def record_errors(topics: DataFrame, concepts: DataFrame, citations: DataFrame, variants: DataFrame) -> DataFrame:
    """Findings of malformed editorial records."""
    outside = lambda c, values: ~F.coalesce(F.col(c).isin(values), F.lit(False))
    malformed = lambda df, key, pattern: finding(df.where(~F.coalesce(F.col(key).rlike(pattern), F.lit(False))), f"bad_{key}", F.col(key), F.col(key))
    evidence = concepts.select("concept_id", F.explode_outer("evidence").alias("e"))
    related = lambda column, known, rule: finding(concepts.select("concept_id", F.explode(column).alias("_r")).join(known, F.col("_r") == F.col("_known"), "left_anti"), rule, F.col("concept_id"), F.col("_r"))
    return together(
        [
            malformed(topics, "topic_id", fixed.TOPIC_ID),
            _missing(topics, "topic_id", ["label", "membership_rule_version", "publication_state"]),
            finding(topics.where(F.coalesce(F.col("membership_rule.type"), F.lit("")) != "title_terms"), "unsupported_membership_rule", F.col("topic_id"), F.col("membership_rule.type")),
            finding(topics.where(F.coalesce(F.size("membership_rule.terms"), F.lit(0)) < 1), "empty_membership_terms", F.col("topic_id"), ""),
            finding(topics.where(outside("publication_state", fixed.PUBLICATION_STATES)), "bad_publication_state", F.col("topic_id"), F.col("publication_state")),
            malformed(concepts, "concept_id", fixed.CONCEPT_ID),
            _missing(concepts, "concept_id", ["canonical_term", "definition_scope", "review_state", "review_role", "reviewed_at", "publication_state"]),
            finding(concepts.where(outside("definition_scope", fixed.DEFINITION_SCOPES)), "bad_definition_scope", F.col("concept_id"), F.col("definition_scope")),
            finding(concepts.where(outside("review_state", fixed.REVIEW_STATES)), "bad_review_state", F.col("concept_id"), F.col("review_state")),
            finding(concepts.where(outside("publication_state", fixed.PUBLICATION_STATES)), "bad_publication_state", F.col("concept_id"), F.col("publication_state")),
            related("related_topic_ids", topics.select(F.col("topic_id").alias("_known")), "unknown_topic"),
            related("related_concept_ids", concepts.select(F.col("concept_id").alias("_known")), "unknown_concept"),
            finding(concepts.where(F.coalesce(F.size("evidence"), F.lit(0)) < 1), "no_evidence", F.col("concept_id"), ""),
            finding(evidence.where("e IS NOT NULL AND (coalesce(e.section_id, '') = '' OR coalesce(e.kind, '') NOT IN ('title', 'text'))"), "malformed_evidence", F.col("concept_id"), F.col("e.section_id")),
            malformed(citations, "citation_target_id", fixed.CITATION_ID),
            _missing(citations, "citation_target_id", ["work_id", "section_id", "anchor", "language"]),
            variant_errors(variants),
        ]
    )


def variant_errors(variants: DataFrame) -> DataFrame:
    """Findings of language variants: one canonical variant an entity, to which every other points."""
    whole = Window.partitionBy("entity_id")
    own = F.col("variant_id") == F.col("canonical_variant_id")
    rows = variants.withColumn("_n", F.sum(F.coalesce(own, F.lit(False)).cast("int")).over(whole)).withColumn("_canonical", F.max(F.when(own, F.col("variant_id"))).over(whole)).withColumn("_own", F.coalesce(own, F.lit(False)))
    others = rows.where("_n = 1 AND NOT _own")
    known = variants.select(F.col("variant_id").alias("_known")).distinct()
    return together(
        [
            finding(variants.groupBy("variant_id").count().where("count > 1"), "duplicate_variant_id", F.col("variant_id"), F.col("count")),
            finding(variants.where(~F.coalesce(F.col("variant_id").rlike(fixed.VARIANT_ID), F.lit(False))), "bad_variant_id", F.col("variant_id"), F.col("variant_id")),
            _missing(variants, "variant_id", ["entity_id", "language", "canonical_name", "translation_status", "review_status"]),
            finding(variants.where(~F.coalesce(F.col("translation_status").isin(fixed.TRANSLATION_STATUSES), F.lit(False))), "bad_translation_status", F.col("variant_id"), F.col("translation_status")),
            finding(rows.where("_n <> 1").select("entity_id", "_n").distinct(), "not_one_canonical_variant", F.col("entity_id"), F.col("_n")),
            finding(others.where("NOT canonical_variant_id <=> _canonical"), "points_at_other_variant", F.col("variant_id"), F.col("canonical_variant_id")),
            finding(others.where("source_variant_id IS NOT NULL AND source_variant_id <> _canonical"), "source_is_not_canonical", F.col("variant_id"), F.col("source_variant_id")),
            finding(variants.where("source_variant_id IS NOT NULL").join(known, F.col("source_variant_id") == F.col("_known"), "left_anti"), "unknown_source_variant", F.col("variant_id"), F.col("source_variant_id")),
        ]
    )


def derived_variants(works: DataFrame, translations: DataFrame, original: str = "en") -> DataFrame:
    """One canonical variant a work, and one a language it is translated into: confirmed if some translation is full.

    works: work_id, title; translations: work_id, language, title, is_full.
    """
    canonical = F.concat(F.lit("lv-"), "work_id", F.lit(f"-{original}"))
    own = works.groupBy("work_id").agg(F.min("title").alias("canonical_name")).select(canonical.alias("variant_id"), "work_id", F.lit(original).alias("language"), "canonical_name", F.lit("canonical").alias("translation_status"), canonical.alias("canonical_variant_id"))
    by = translations.groupBy("work_id", "language").agg(F.min("title").alias("canonical_name"), F.max(F.col("is_full").cast("int")).alias("full"))
    other = by.select(F.concat(F.lit("lv-"), "work_id", F.lit("-"), "language").alias("variant_id"), "work_id", "language", "canonical_name", F.when(F.col("full") == 1, "confirmed").otherwise("provisional").alias("translation_status"), canonical.alias("canonical_variant_id"))
    return own.unionByName(other)


def entities(topics: DataFrame, concepts: DataFrame, variants: DataFrame, citations: DataFrame) -> DataFrame:
    """entity_id, kind, label and language of everything the semantic layer publishes, each once: of several the least by kind, label and language.

    topics: topic_id, label; concepts: concept_id, canonical_term; variants: variant_id, canonical_name, language; citations: citation_target_id, anchor, language.
    """
    one = lambda df, key, kind, label, language: df.select(F.col(key).alias("entity_id"), F.lit(kind).alias("kind"), F.col(label).alias("label"), (F.col(language) if language else F.lit(None).cast("string")).alias("language"))
    every = [one(topics, "topic_id", "topic", "label", None), one(concepts, "concept_id", "concept", "canonical_term", None), one(variants, "variant_id", "language_variant", "canonical_name", "language"), one(citations, "citation_target_id", "citation", "anchor", "language")]
    least = F.min(F.struct("kind", "label", "language")).alias("_least")
    return together(every).groupBy("entity_id").agg(least).select("entity_id", "_least.*")
