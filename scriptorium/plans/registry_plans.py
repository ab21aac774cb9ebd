"""Queries over registries, policies, audits and gates, on the tables of the driver.

A document's text stands for a media object's bytes; a toxic label for a third party's signal, a quality label for the author's.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from ..functions import fixed, media, text
from ..operators import audit, catalog, gate, publish, registry, sections, semantic, volumes
from .section_plans import CHUNKS, TITLE, damaged, documents

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def labelled(spark, sf_dir):
    """Documents with third (toxic) and own (quality), false where no label says so."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    rows = documents(spark, sf_dir).join(labels, "doc_id", "left").withColumn("sha", F.sha2("text", 256))
    return rows.withColumn("third", F.coalesce(F.col("toxic") == 1, F.lit(False))).withColumn("own", F.coalesce(F.col("quality") == 1, F.lit(False)))


LABELLED = """l AS (SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (SELECT d.doc_id, d.source, d.text, sha256(d.text) AS sha, coalesce(l.toxic = 1, false) AS third, coalesce(l.quality = 1, false) AS own, l.doc_id IS NOT NULL AS labelled FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id)"""

# topics and concepts of the tables' invented language
TOPICS = [("topic-the", 1, ["the"]), ("topic-ver", 2, ["ver", "be"]), ("topic-que", 3, ["que"]), ("topic-none", 4, ["zzzz"])]
NORM = rf"regexp_replace(lower({TITLE}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g')"
TOPIC_SQL = f"CASE WHEN contains({NORM}, 'the') THEN 'topic-the' WHEN contains({NORM}, 'ver') OR contains({NORM}, 'be') THEN 'topic-ver' WHEN contains({NORM}, 'que') THEN 'topic-que' END"


def members(spark, sf_dir):
    topics = spark.createDataFrame(TOPICS, "topic_id string, priority int, terms array<string>")
    return semantic.topic_members(topics, sections.sections(documents(spark, sf_dir)))


@query(f"SELECT * FROM (SELECT {TOPIC_SQL} AS topic_id, doc_id AS section_id FROM documents) WHERE topic_id IS NOT NULL")
def topic_membership(spark, sf_dir):
    return members(spark, sf_dir).select("topic_id", "section_id")


@query(f"WITH m AS (SELECT {TOPIC_SQL} AS topic_id, doc_id AS section_id FROM documents), r AS (SELECT topic_id, section_id, CAST(row_number() OVER (PARTITION BY topic_id ORDER BY section_id) AS INTEGER) AS place FROM m WHERE topic_id IS NOT NULL) SELECT * FROM r WHERE place <= 15")
def topic_top15(spark, sf_dir):
    return semantic.topic_lists(members(spark, sf_dir).select("topic_id", "section_id"), "section_id")


def concepts(spark, sf_dir):
    """A concept for each benchmark item, named by its first word; documents are evidence of the item their id leads to."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", F.substring_index("text", " ", 1).alias("canonical_term"))
    kind = F.when(F.col("doc_id") % 2 == 0, "title").otherwise("text")
    named = F.struct(F.col("doc_id").alias("section_id"), kind.alias("kind"), F.when(F.col("doc_id") % 3 == 0, "ver").alias("term"))
    given = documents(spark, sf_dir).groupBy((F.col("doc_id") % 40).alias("item_id")).agg(F.collect_list(named).alias("evidence"))
    state = F.when(F.col("item_id") % 5 == 0, "draft").otherwise("published")
    return items.join(given, "item_id").select(F.concat(F.lit("cp-"), F.col("item_id").cast("string")).alias("concept_id"), "canonical_term", F.array(F.lit("tion")).alias("aliases"), "evidence", F.when(F.col("item_id") % 3 == 0, "unreviewed").otherwise("reviewed").alias("review_state"), state.alias("publication_state"))


BODY = r"regexp_replace(lower(text), '[^\p{L}\p{N}_]+', ' ', 'g')"
_NORM_OF = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g')"
EVIDENCE = f"""e AS (SELECT b.item_id, 'cp-' || b.item_id AS concept_id, split_part(b.text, ' ', 1) AS canon, d.doc_id, d.text, CASE WHEN d.doc_id % 2 = 0 THEN 'title' ELSE 'text' END AS kind, CASE WHEN d.doc_id % 3 = 0 THEN 'ver' END AS term
  FROM benchmark b JOIN documents d ON d.doc_id % 40 = b.item_id),
h AS (SELECT *, CASE WHEN kind = 'title' THEN {NORM} ELSE {BODY} END AS hay FROM e),
v AS (SELECT concept_id, doc_id AS section_id, kind FROM h WHERE contains(hay, {_NORM_OF.format("coalesce(term, canon)")}) OR contains(hay, {_NORM_OF.format("canon")}) OR contains(hay, 'tion'))"""


@query(f"WITH {EVIDENCE} SELECT concept_id, section_id, kind FROM v")
def concept_evidence(spark, sf_dir):
    return semantic.verified_evidence(concepts(spark, sf_dir), sections.sections(documents(spark, sf_dir))).select("concept_id", "section_id", "kind")


@query(f"""WITH {EVIDENCE}, n AS (SELECT concept_id, count(*) AS n FROM v GROUP BY concept_id)
SELECT c.concept_id, coalesce(n.n, 0) AS n_evidence, c.item_id % 5 <> 0 AND c.item_id % 3 <> 0 AND coalesce(n.n, 0) > 0 AS is_published FROM (SELECT DISTINCT concept_id, item_id FROM e) c LEFT JOIN n ON c.concept_id = n.concept_id""")
def concepts_published(spark, sf_dir):
    return semantic.published_concepts(concepts(spark, sf_dir), sections.sections(documents(spark, sf_dir)))


# a document is a surface: its kind by its length, its states by its labels and language, supported if its text says so
@query("""WITH l AS (SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality FROM labels GROUP BY doc_id),
s AS (SELECT d.doc_id, ['topic', 'concept', 'language_variant', 'work', 'section', 'chunk', 'figure', 'volume_index', 'alias'][CAST(length(text) % 9 AS INTEGER) + 1] AS kind, CASE quality WHEN 1 THEN 'published' WHEN 0 THEN 'draft' END AS publication,
  CASE toxic WHEN 0 THEN 'reviewed' WHEN 1 THEN 'unreviewed' END AS review, CASE lang WHEN 'en' THEN 'canonical' WHEN 'de' THEN 'confirmed' WHEN 'fr' THEN 'provisional' END AS translation, contains(lower(text), 'the') AS supported FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id)
SELECT doc_id, kind, CASE WHEN kind = 'topic' THEN coalesce(publication = 'published', false) AND supported
  WHEN kind = 'concept' THEN coalesce(publication = 'published', false) AND coalesce(review = 'reviewed', false) AND supported
  WHEN kind = 'language_variant' THEN coalesce(translation = 'confirmed', false) AND coalesce(review = 'reviewed', false)
  ELSE coalesce(kind IN ('work', 'section', 'volume_index', 'landing', 'topics_index', 'concepts_index', 'figure'), false) END AS indexable FROM s""")
def indexable_policy(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    kinds = F.array(*map(F.lit, ("topic", "concept", "language_variant", "work", "section", "chunk", "figure", "volume_index", "alias")))
    rows = documents(spark, sf_dir).join(labels, "doc_id", "left").withColumns({
        "kind": F.get(kinds, F.length("text") % 9), "publication": F.when(F.col("quality") == 1, "published").when(F.col("quality") == 0, "draft"), "review": F.when(F.col("toxic") == 0, "reviewed").when(F.col("toxic") == 1, "unreviewed"),
        "translation": F.when(F.col("lang") == "en", "canonical").when(F.col("lang") == "de", "confirmed").when(F.col("lang") == "fr", "provisional"), "supported": F.contains(F.lower("text"), F.lit("the")),
    })
    return rows.select("doc_id", "kind", media.indexable(*[F.col(c) for c in ("kind", "publication", "review", "translation", "supported")]).alias("indexable"))


# a variant is a language of a source; how many documents it has decides what is wrong with it
@query("""
WITH g AS (SELECT source, lang, count(*) AS n, max(length(text)) AS longest FROM documents GROUP BY source, lang),
v AS (SELECT CASE WHEN longest % 5 = 0 THEN 'BAD ' || source || lang ELSE 'lv-' || source || '-' || lang END AS variant_id, source AS entity_id, CASE WHEN n % 7 = 0 THEN '' ELSE source END AS canonical_name,
  CASE WHEN n % 5 = 0 THEN 'wrong' WHEN lang = 'en' THEN 'canonical' ELSE 'confirmed' END AS translation_status, CASE WHEN lang <> 'en' THEN CASE WHEN n % 3 = 0 THEN 'lv-' || source || '-zz' WHEN n % 3 = 1 THEN 'lv-' || source || '-de' ELSE 'lv-' || source || '-en' END END AS source_variant_id,
  CASE WHEN lang = 'en' OR n % 11 = 0 THEN CASE WHEN longest % 5 = 0 THEN 'BAD ' || source || lang ELSE 'lv-' || source || '-' || lang END WHEN n % 4 = 0 THEN 'lv-' || source || '-fr' ELSE 'lv-' || source || '-en' END AS canonical_variant_id FROM g),
c AS (SELECT entity_id, count(*) FILTER (WHERE variant_id = canonical_variant_id) AS n, max(CASE WHEN variant_id = canonical_variant_id THEN variant_id END) AS canon FROM v GROUP BY entity_id),
o AS (SELECT v.*, c.canon FROM v JOIN c ON v.entity_id = c.entity_id WHERE c.n = 1 AND v.variant_id <> v.canonical_variant_id)
SELECT 'bad_variant_id' AS rule, variant_id AS entity_key FROM v WHERE NOT regexp_matches(variant_id, '^lv-[a-z0-9а-яё][a-z0-9а-яё-]*$')
UNION ALL SELECT 'missing_field', variant_id FROM v WHERE canonical_name = ''
UNION ALL SELECT 'bad_translation_status', variant_id FROM v WHERE translation_status NOT IN ('canonical', 'provisional', 'confirmed', 'absent')
UNION ALL SELECT 'not_one_canonical_variant', entity_id FROM c WHERE n <> 1
UNION ALL SELECT 'points_at_other_variant', variant_id FROM o WHERE canonical_variant_id <> canon
UNION ALL SELECT 'source_is_not_canonical', variant_id FROM o WHERE source_variant_id <> canon
UNION ALL SELECT 'unknown_source_variant', variant_id FROM v WHERE source_variant_id IS NOT NULL AND source_variant_id NOT IN (SELECT variant_id FROM v)""")
def variant_chain_errors(spark, sf_dir):
    return semantic.variant_errors(_variants(spark, sf_dir)).select("rule", "entity_key")


def _variants(spark, sf_dir):
    rows = documents(spark, sf_dir).groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("text")).alias("longest"))
    of = lambda lang: F.concat(F.lit("lv-"), "source", F.lit("-"), lang)
    n, english = F.col("n"), F.col("lang") == "en"
    own = F.when(F.col("longest") % 5 == 0, F.concat(F.lit("BAD "), "source", "lang")).otherwise(of(F.col("lang")))
    return rows.select(
        own.alias("variant_id"), F.col("source").alias("entity_id"), F.col("lang").alias("language"), F.when(n % 7 == 0, "").otherwise(F.col("source")).alias("canonical_name"),
        F.when(n % 5 == 0, "wrong").when(english, "canonical").otherwise("confirmed").alias("translation_status"), F.lit("reviewed").alias("review_status"),
        F.when(~english, F.when(n % 3 == 0, of(F.lit("zz"))).when(n % 3 == 1, of(F.lit("de"))).otherwise(of(F.lit("en")))).alias("source_variant_id"),
        F.when(english | (n % 11 == 0), own).when(n % 4 == 0, of(F.lit("fr"))).otherwise(of(F.lit("en"))).alias("canonical_variant_id"),
    )


@query(r"""
WITH t AS (SELECT source AS work_id, lang AS language, min(doc_id) AS d, max(CASE WHEN length(regexp_replace(text, '[^\p{L}\p{N}_]', '', 'g')) >= 200 THEN 1 ELSE 0 END) AS full_text FROM documents WHERE lang <> 'en' GROUP BY 1, 2)
SELECT 'lv-' || source || '-en' AS variant_id, source AS work_id, 'en' AS language, 'canonical' AS translation_status FROM documents GROUP BY source
UNION ALL SELECT 'lv-' || work_id || '-' || language, work_id, language, CASE WHEN full_text = 1 THEN 'confirmed' ELSE 'provisional' END FROM t""")
def derived_variants(spark, sf_dir):
    docs = documents(spark, sf_dir)
    works = docs.select(F.col("source").alias("work_id"), F.col("source").alias("title"))
    full = text.word_chars(F.col("text")) >= fixed.FULL_TEXT_LEAST_WORD_CHARS
    translations = docs.where("lang <> 'en'").select(F.col("source").alias("work_id"), F.col("lang").alias("language"), F.lit("t").alias("title"), full.alias("is_full"))
    return semantic.derived_variants(works, translations).select("variant_id", "work_id", "language", "translation_status")


# topics of the languages, concepts of the benchmark, citations of the pages, with faults of every kind, and the variants above
@query(f"""
WITH t AS (SELECT lang, CASE WHEN lang = 'de' THEN 'Topic de' ELSE 'topic-' || lang END AS id FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
c AS (SELECT item_id AS i, CASE WHEN item_id % 7 = 0 THEN 'CP ' || item_id ELSE 'cp-' || item_id END AS id FROM benchmark), p AS (SELECT page_id AS i, CASE WHEN page_id % 17 = 0 THEN 'CT' || page_id ELSE 'ct-' || page_id END AS id FROM pages),
r AS (
  SELECT 'bad_topic_id' AS rule, id FROM t WHERE NOT regexp_matches(id, '^topic-[a-z0-9][a-z0-9-]*$') UNION ALL SELECT 'missing_field', id FROM t WHERE lang = 'en' UNION ALL SELECT 'unsupported_membership_rule', id FROM t WHERE lang = 'en'
  UNION ALL SELECT 'empty_membership_terms', id FROM t WHERE lang = 'de' UNION ALL SELECT 'bad_publication_state', id FROM t WHERE lang = 'de'
  UNION ALL SELECT 'bad_concept_id', id FROM c WHERE NOT regexp_matches(id, '^cp-[a-z0-9][a-z0-9-]*$') UNION ALL SELECT 'missing_field', id FROM c WHERE i % 5 = 0 UNION ALL SELECT 'bad_definition_scope', id FROM c WHERE i % 6 = 0
  UNION ALL SELECT 'bad_review_state', id FROM c WHERE i % 8 = 0 UNION ALL SELECT 'bad_publication_state', id FROM c WHERE i % 10 = 0 UNION ALL SELECT 'unknown_topic', id FROM c WHERE CASE WHEN i % 11 = 0 THEN 'topic-zz' ELSE 'topic-en' END NOT IN (SELECT id FROM t)
  UNION ALL SELECT 'unknown_concept', id FROM c WHERE CASE WHEN i % 13 = 0 THEN 'cp-none' ELSE 'cp-1' END NOT IN (SELECT id FROM c) UNION ALL SELECT 'no_evidence', id FROM c WHERE i % 4 = 0 UNION ALL SELECT 'malformed_evidence', id FROM c WHERE i % 4 <> 0 AND i % 9 = 0
  UNION ALL SELECT 'bad_citation_target_id', id FROM p WHERE NOT regexp_matches(id, '^ct-[a-z0-9][a-z0-9-]*$') UNION ALL SELECT 'missing_field', id FROM p WHERE i % 19 = 0
  UNION ALL SELECT rule, entity_key FROM ({ORACLE_SQL["variant_chain_errors"]}))
SELECT 'block' AS severity, rule, id AS entity_key FROM r""")
def record_validation(spark, sf_dir):
    lang, i, at = F.col("lang"), F.col("item_id"), F.col("page_id")
    terms = F.when(lang == "de", F.array().cast("array<string>")).otherwise(F.array(lang))
    rule = F.struct(F.when(lang == "en", "other").otherwise("title_terms").alias("type"), terms.alias("terms"))
    topics = documents(spark, sf_dir).where("lang IS NOT NULL").select("lang").distinct().select(
        F.when(lang == "de", "Topic de").otherwise(F.concat(F.lit("topic-"), lang)).alias("topic_id"), F.when(lang == "en", "").otherwise(lang).alias("label"), rule.alias("membership_rule"), F.lit(1).alias("membership_rule_version"), F.when(lang == "de", "gone").otherwise("published").alias("publication_state")
    )
    pick = lambda n, odd, even: F.when(i % n == 0, odd).otherwise(even)
    kind = F.struct(F.lit("1").alias("section_id"), pick(9, "other", "title").alias("kind"), F.lit(None).cast("string").alias("term"))
    evidence = F.when(i % 4 == 0, F.array().cast("array<struct<section_id:string,kind:string,term:string>>")).otherwise(F.array(kind))
    concept = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        pick(7, F.concat(F.lit("CP "), i.cast("string")), F.concat(F.lit("cp-"), i.cast("string"))).alias("concept_id"), pick(5, "", "x").alias("canonical_term"), pick(6, "guess", "corpus_term").alias("definition_scope"), evidence.alias("evidence"),
        pick(8, "seen", "reviewed").alias("review_state"), F.lit("editor").alias("review_role"), F.lit("2020").alias("reviewed_at"), pick(10, "gone", "published").alias("publication_state"), F.array(pick(11, "topic-zz", "topic-en")).alias("related_topic_ids"), F.array(pick(13, "cp-none", "cp-1")).alias("related_concept_ids"),
    )
    citations = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.concat(F.when(at % 17 == 0, "CT").otherwise("ct-"), at.cast("string")).alias("citation_target_id"), F.when(at % 19 == 0, "").otherwise("w").alias("work_id"), F.lit("s").alias("section_id"), F.lit("a").alias("anchor"), F.lit("en").alias("language"))
    return semantic.record_errors(topics, concept, citations, _variants(spark, sf_dir)).select("severity", "rule", "entity_key")


@query("SELECT source AS work_id, count(*) AS n_sections, CAST(sum(length(text)) AS BIGINT) AS n_chars, sha256(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id)) AS sections_sha FROM documents GROUP BY source")
def work_catalog(spark, sf_dir):
    return catalog.work_catalog(sections.sections(documents(spark, sf_dir)))


@query("""
WITH w AS (SELECT doc_id AS title, CASE WHEN doc_id % 7 <> 0 THEN CAST(1990 + doc_id % 30 AS VARCHAR) WHEN doc_id % 14 = 0 THEN '1985' ELSE 'н/д' END AS year FROM documents)
SELECT year, CAST(title AS VARCHAR) AS title, CAST(row_number() OVER (ORDER BY year, CAST(title AS VARCHAR)) AS BIGINT) AS place FROM w""")
def chronology(spark, sf_dir):
    day = F.when(F.col("doc_id") % 7 != 0, F.concat((1990 + F.col("doc_id") % 30).cast("string"), F.lit("-05-01"))).when(F.col("doc_id") % 2 == 0, "")
    rows = documents(spark, sf_dir).select(day.alias("date"), F.when(F.col("doc_id") % 14 == 0, "1985").otherwise("").alias("year"), F.col("doc_id").cast("string").alias("title"))
    return catalog.chronology(rows)


@query("SELECT lang AS language, count(*) AS n FROM documents WHERE lang <> 'en' GROUP BY lang")
def languages_index(spark, sf_dir):
    return catalog.languages(documents(spark, sf_dir).where("lang <> 'en'").withColumnRenamed("lang", "language"))


@query(r"""
WITH t AS (SELECT lang, source, length(regexp_replace(text, '[^\p{L}\p{N}_]', '', 'g')) >= 200 AS is_full FROM documents WHERE lang <> 'en')
SELECT count(*) AS n_entries, count(DISTINCT lang) AS n_languages, count(*) FILTER (WHERE is_full) AS n_full, count(*) FILTER (WHERE NOT is_full) AS n_cards FROM t""")
def translation_stats(spark, sf_dir):
    rows = documents(spark, sf_dir).where("lang <> 'en'").select(F.col("lang").alias("language"), (text.word_chars(F.col("text")) >= fixed.FULL_TEXT_LEAST_WORD_CHARS).alias("is_full"))
    return catalog.translation_totals(rows)


@query(r"""
WITH s AS (SELECT page_id, url, list_extract(string_split(rtrim(url, '/'), '/'), -1) AS last FROM pages),
n AS (SELECT page_id, url, substring(regexp_replace(last, '[^\p{L}\p{N}_.-]+', '_', 'g'), 1, 60) AS name FROM s),
k AS (SELECT page_id, url, lower(CASE WHEN name = '' THEN 'item' ELSE name END) AS slug FROM n),
r AS (SELECT page_id, slug, row_number() OVER (PARTITION BY slug ORDER BY page_id) AS n FROM k)
SELECT page_id, CASE WHEN n = 1 THEN slug ELSE slug || '-' || n END AS item_id FROM r""")
def translation_ledger(spark, sf_dir):
    return catalog.ledger(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), "url", "page_id").select("page_id", "item_id")


@query(f"WITH {LABELLED} SELECT doc_id, sha, min(doc_id) OVER (PARTITION BY sha) AS canonical_id, doc_id = min(doc_id) OVER (PARTITION BY sha) AS is_first FROM d")
def canonical_objects(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("sha"))
    return registry.canonical_objects(rows, "doc_id", ["doc_id"]).select("doc_id", "sha", "canonical_id", "is_first")


STAGED = f"""{LABELLED}, f AS (SELECT d.*, min(doc_id) OVER (PARTITION BY sha) AS canonical_id, strlen(text) AS size FROM d),
s AS (SELECT *, CASE WHEN doc_id <> canonical_id THEN 'duplicate' WHEN third OR NOT own THEN 'metadata_only_rights' WHEN size < 2048 AND labelled = false THEN 'decorative_excluded' ELSE 'published' END AS status FROM f)"""


def staged(spark, sf_dir):
    rows = registry.canonical_objects(labelled(spark, sf_dir), "doc_id", ["doc_id"])
    critical = media.criticality(F.lit("other"), F.lit(".png"), F.lit(None).cast("string"), F.octet_length("text"), F.lit(None).cast("int"))
    rights = F.when(F.col("third"), "rights_review_required").when(F.col("own"), "authorial").otherwise("unknown")
    status = media.staging(F.col("text").isNotNull(), F.col("is_first"), rights, critical, F.col("toxic").isNotNull(), F.lit(".png"))
    rows = rows.withColumn("publication_status", status)
    return rows.withColumn("duplicate_of", F.when(~F.col("is_first"), F.col("canonical_id")))


@query(f"WITH {STAGED} SELECT doc_id, status AS publication_status FROM s")
def staging_status(spark, sf_dir):
    return staged(spark, sf_dir).select("doc_id", "publication_status")


@query(f"WITH {STAGED} SELECT a.doc_id, b.status AS effective_status, CASE WHEN b.status NOT IN ('published', 'duplicate') THEN b.status END AS duplicate_blocked_by FROM s a JOIN s b ON b.doc_id = a.canonical_id WHERE a.status = 'duplicate'")
def duplicate_effective_status(spark, sf_dir):
    rows = registry.effective_status(staged(spark, sf_dir), "doc_id")
    return rows.where("publication_status = 'duplicate'").select("doc_id", "effective_status", "duplicate_blocked_by")


@query(f"WITH {STAGED} SELECT source AS work_id, count(*) AS n_figures, count(*) FILTER (WHERE status IN ('published', 'duplicate')) AS n_published FROM s GROUP BY source")
def registry_status_counts(spark, sf_dir):
    return registry.status_counts(staged(spark, sf_dir).withColumnRenamed("source", "work_id"))


@query(f"WITH {LABELLED}, g AS (SELECT *, max(third) OVER (PARTITION BY sha) AS any_third, max(own) OVER (PARTITION BY sha) AS any_own FROM (SELECT doc_id, sha, CAST(third AS INTEGER) AS third, CAST(own AS INTEGER) AS own FROM d)) SELECT doc_id, (own = 0 AND any_third = 0 AND any_own = 1) AS promoted FROM g")
def sha_group_promotion(spark, sf_dir):
    rows = registry.group_promotion(labelled(spark, sf_dir), "sha", F.col("third"), F.col("own"), ~F.col("own"))
    return rows.select("doc_id", "promoted")


KEYWORDS = [("tion", "scheme"), ("ver", "chart"), ("que", "map"), ("ing", "photo")]


@query(f"SELECT doc_id, CASE WHEN contains(lower({TITLE}), 'tion') THEN 'scheme' WHEN contains(lower({TITLE}), 'ver') THEN 'chart' WHEN contains(lower({TITLE}), 'que') THEN 'map' WHEN contains(lower({TITLE}), 'ing') THEN 'photo' WHEN doc_id % 3 = 0 THEN 'scheme' ELSE 'other' END AS media_type FROM documents")
def media_type_cascade(spark, sf_dir):
    ext = F.when(F.col("doc_id") % 3 == 0, ".wmf").otherwise(".png")
    return documents(spark, sf_dir).select("doc_id", media.media_type(text.title_of(F.col("text")), ext, KEYWORDS).alias("media_type"))


PATTERNS = SimpleNamespace(COVER=r"ung\b", SCREENSHOT=r"sch", PHOTO=r"que\b", REPRODUCTION=r"https?://|www\.", SCHEME=r"ment", TABLE=r"tion\b", TABLE_LABEL=r"tab", LABEL=r"fig", VECTOR=[".wmf"])
_CONTEXT = f"regexp_replace(regexp_replace({TITLE} || ' ' || text, '!\\[[^\\]]*\\]\\([^)]*\\)', ' ', 'g'), '<[^>]+>', ' ', 'g')"


@query(rf"""
WITH c AS (SELECT doc_id, {_CONTEXT} AS ctx, {TITLE} AS cap FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(ctx, '(?i)ung($|[^\p{{L}}\p{{N}}_])') THEN 'cover_or_external_art' WHEN regexp_matches(ctx, '(?i)sch') THEN 'screenshot_or_document_scan' WHEN regexp_matches(ctx, '(?i)que($|[^\p{{L}}\p{{N}}_])') THEN 'third_party_photo'
  WHEN regexp_matches(ctx, '(?i)https?://|www\.') THEN 'third_party_reproduction' WHEN regexp_matches(cap, '(?i)tion($|[^\p{{L}}\p{{N}}_])') THEN 'authorial_table_or_chart'
  WHEN doc_id % 7 = 0 THEN 'authorial_scheme_or_diagram' WHEN regexp_matches(cap, '(?i)ment') THEN 'authorial_scheme_or_diagram' ELSE 'unclear_after_second_pass' END AS class FROM c""")
def provenance_class(spark, sf_dir):
    ext = F.when(F.col("doc_id") % 7 == 0, ".wmf").otherwise(".png")
    found = media.provenance(F.lit("other"), text.title_of(F.col("text")), F.lit(None).cast("string"), F.col("text"), ext, PATTERNS)
    return documents(spark, sf_dir).select("doc_id", found["class"].alias("class"))


@query("SELECT doc_id, CASE WHEN strlen(text) < 2048 THEN 'decorative' WHEN doc_id % 5 = 0 THEN 'critical_for_understanding' WHEN lang = 'de' THEN 'useful' ELSE 'unclear' END AS criticality FROM documents")
def criticality(spark, sf_dir):
    ext, label = F.when(F.col("doc_id") % 5 == 0, ".emf").otherwise(".png"), F.when(F.col("lang") == "de", "Fig. 1")
    return documents(spark, sf_dir).select("doc_id", media.criticality(F.lit("other"), ext, label, F.octet_length("text"), F.lit(None).cast("int")).alias("criticality"))


@query(r"SELECT doc_id, source, sha256(regexp_replace(text, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+(\.[\p{L}\p{N}_-]+)+', '[email]', 'g')) AS sha FROM documents")
def public_record_redaction(spark, sf_dir):
    return registry.public_record(documents(spark, sf_dir), ["doc_id", "source", "text"]).select("doc_id", "source", F.sha2("text", 256).alias("sha"))


@query("SELECT doc_id, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS INTEGER) AS n_masked, sha256(replace(text, 'the', '***')) AS sha FROM documents")
def public_masks_counts(spark, sf_dir):
    t = F.col("text")
    return documents(spark, sf_dir).select("doc_id", text.occurrences(t, "the").alias("n_masked"), F.sha2(text.mask(t, "the", "***"), 256).alias("sha"))


_TEXT_RULES = r"""SELECT {0} AS key, 'personal Drive link' AS label FROM {1} WHERE regexp_matches({2}, '(?i)drive\.google|googledrive|docs\.google\.com/drive')
  UNION ALL SELECT {0}, 'e-mail address' FROM {1} WHERE regexp_matches(regexp_replace({2}, '(?i)@users\.noreply\.github\.com', '', 'g'), '(?i)[\w.+-]{{2,}}@[\w-]{{2,}}\.[\w.]{{2,}}')
  UNION ALL SELECT {0}, 'personal path/username' FROM {1} WHERE regexp_matches({2}, '[A-Za-z]:\\Users\\')
  UNION ALL SELECT {0}, 'literal' FROM {1} WHERE regexp_matches({2}, '(?i)apache LICENSE')"""


@query(_TEXT_RULES.format("'documents/' || doc_id", "documents", "text") + " UNION ALL " + _TEXT_RULES.format("'pages/' || page_id", "pages", "html") + r"""
  UNION ALL SELECT 'pages/' || page_id, 'internal review data' FROM pages WHERE regexp_matches(html, 'media_review_queue|ole_review_queue|release_approval')
  UNION ALL SELECT 'pages/' || page_id, 'internal workspace path' FROM pages WHERE contains(html, '/mnt/data')
  UNION ALL SELECT 'pages/' || page_id, 'javascript: URL in output' FROM pages WHERE regexp_matches(html, '(?i)javascript\s*:')
  UNION ALL SELECT 'pages/' || page_id, 'inline/foreign script tag' FROM pages WHERE regexp_matches(regexp_replace(html, '(?i)<script[^>]*(assets/(reader|search)\.js|application/ld\+json)', '', 'g'), '(?i)<script')
  UNION ALL SELECT 'pages/' || page_id, 'opaque external file id' FROM pages WHERE regexp_matches(html, '[?&]id=[\w-]{20,}')""")
def forbidden_scan(spark, sf_dir):
    """Texts by the rules for texts, pages by those for rendered pages too."""
    docs = documents(spark, sf_dir).select(F.concat(F.lit("documents/"), F.col("doc_id").cast("string")).alias("key"), "text")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.concat(F.lit("pages/"), F.col("page_id").cast("string")).alias("key"), F.col("html").alias("text"))
    return audit.forbidden_texts(docs, "key", "text", literals=["Apache License"]).unionByName(audit.forbidden_texts(pages, "key", "text", True, ["Apache License"]))


# every text holds a run that decodes: an address, a plain note or zeros
_RUN = "CASE doc_id % 3 WHEN 0 THEN 'write to someone' || doc_id || '@example.org today' WHEN 1 THEN 'nothing to see here, ' || doc_id || ' is fine' ELSE chr(0) || 'binary data behind a zero byte ' || doc_id END"


@query(rf"""
WITH h AS (SELECT doc_id, text || ' ' || base64(encode({_RUN})) || ' ' AS text FROM documents),
r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9+/]{{40,}}={{0,2}}')) AS run FROM h),
b AS (SELECT doc_id, CASE WHEN length(run) % 4 = 0 THEN hex(from_base64(run)) END AS x FROM r),
t AS (SELECT doc_id, x IS NOT NULL AND NOT regexp_matches(x, '^(..)*00') AND regexp_matches(x, '^(..)*((2[0-9A-F]|[3-6][0-9A-F]|7[0-9A-E])){{6}}') AS told, x FROM b)
SELECT doc_id, count(*) AS n_runs, count(*) FILTER (WHERE told) AS n_decoded, CASE WHEN count(*) FILTER (WHERE told AND regexp_matches(x, '736F6D656F6E65(3[0-9])+406578616D706C652E6F7267')) > 0 THEN 'e-mail address' ELSE '' END AS labels FROM t GROUP BY doc_id""")
def base64_decoded_scan(spark, sf_dir):
    hidden = F.concat("text", F.lit(" "), F.base64(F.encode(F.expr(_RUN.replace("chr(0)", "char(0)")), "UTF-8")), F.lit(" "))
    return audit.hidden_texts(documents(spark, sf_dir).select("doc_id", hidden.alias("text")), "doc_id", "text")


@query("""SELECT page_id, unnest(regexp_extract_all(html, '(?:href|src)="([^"#]+?)"', 1)) AS target FROM pages""")
def html_link_extract(spark, sf_dir):
    return audit.html_links(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "html").select("page_id", "target")


@query("""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?:href|src)="([^"#]+?)"', 1)) AS target FROM pages),
k AS (SELECT DISTINCT regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*/', ''), '[?#].*$', '') AS path FROM pages)
SELECT page_id, target FROM l WHERE ltrim(target, '/') NOT IN (SELECT path FROM k)""")
def link_audit(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    files = pages.select(F.regexp_replace(F.regexp_replace("url", "^[a-z]+://[^/]*/", ""), "[?#].*$", "").alias("path")).distinct()
    links = audit.html_links(pages, "page_id", "html").withColumn("path", F.lit(""))
    return audit.unresolved(links, files).select("page_id", "target")


# every document links to the next id, which is a neighbour or not, to a file that is gone, abroad and to the writer's disk
@query("""
SELECT d.source || '/' || d.doc_id || '.md' AS path, 'See ' || CASE WHEN n.doc_id IS NULL THEN 'one' ELSE '[one](' || n.doc_id || '.md)' END || ', two and [three](https://e.org/' || d.doc_id || '). ![pic](p.png) mine' AS text,
  CAST(CASE WHEN n.doc_id IS NULL THEN 1 ELSE 2 END AS BIGINT) AS kept, CAST(CASE WHEN n.doc_id IS NULL THEN 3 ELSE 2 END AS BIGINT) AS neutralised
FROM documents d LEFT JOIN documents n ON n.doc_id = d.doc_id + 1 AND n.source = d.source""")
def md_link_neutralise(spark, sf_dir):
    id_ = F.col("doc_id").cast("string")
    path = F.concat("source", F.lit("/"), id_, F.lit(".md"))
    body = F.concat(F.lit("See [one]("), (F.col("doc_id") + 1).cast("string"), F.lit(".md), [two](../gone"), id_, F.lit(".md) and [three](https://e.org/"), id_, F.lit("). ![pic](p.png) [mine](file:///c)"))
    docs = documents(spark, sf_dir).select(path.alias("path"), body.alias("text"))
    return publish.neutralise_links(docs, docs.select("path"))


@query("""
WITH h AS (SELECT p.item_id, count(*) AS n, min(d.doc_id) AS section_id FROM benchmark p JOIN documents d ON contains(d.text, p.text) GROUP BY p.item_id)
SELECT item_id, section_id FROM h WHERE n = 1""")
def unique_context_match(spark, sf_dir):
    probes = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", F.lit(0).alias("rank"), F.col("text").alias("phrase"))
    return registry.unique_context(probes, sections.sections(documents(spark, sf_dir)).select("section_id", "body"))


@query("SELECT source || '/' || doc_id || '.txt' AS path, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM documents")
def manifest(spark, sf_dir):
    return audit.manifest(documents(spark, sf_dir).select(F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"), F.col("text").alias("content")))


@query("""
SELECT doc_id, source FROM documents WHERE (doc_id % 50 IN (1, 2, 3) OR lang = 'de' OR source IN ('src1', 'src2')) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)""")
def scope_filter(spark, sf_dir):
    excluded = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id")
    rows = documents(spark, sf_dir).select("doc_id", "source", (F.col("doc_id") % 50).alias("volume"), F.col("lang").alias("section_id"), F.col("source").alias("id"))
    return catalog.in_scope(rows, [1, 2, 3], ["de"], ["src1", "src2"]).select("doc_id", "source").join(excluded, "doc_id", "left_anti")


@query("SELECT doc_id, 'unlabelled' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'labelled' FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY doc_id")
def set_differences(spark, sf_dir):
    docs, marked = documents(spark, sf_dir).select("doc_id"), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    only = sections.set_difference(docs, marked, "doc_id").where("side = 'left'").select("doc_id", F.lit("unlabelled").alias("side"))
    return only.unionByName(sections.intersection(docs, marked, "doc_id").withColumn("side", F.lit("labelled")))


@query("""
WITH a AS (SELECT 'assets/media/' || doc_id || CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE '' END AS path, CASE WHEN doc_id % 10 = 0 THEN 'changed' ELSE sha256(text) END AS sha FROM documents), s AS (SELECT 'assets/media/' || doc_id AS path, sha256(text) AS sha FROM documents)
SELECT coalesce(a.path, s.path) AS entity_key, CASE WHEN s.path IS NULL THEN 'allowed_file_missing' WHEN a.path IS NULL THEN 'file_not_allowed' ELSE 'file_changed' END AS rule FROM a FULL OUTER JOIN s ON a.path = s.path WHERE a.path IS NULL OR s.path IS NULL OR a.sha <> s.sha""")
def allowlist_reconcile(spark, sf_dir):
    shipped = documents(spark, sf_dir).select("doc_id", F.concat(F.lit("assets/media/"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"))
    other = F.concat("path", F.when(F.col("doc_id") % 3 == 0, "x").otherwise(""))
    allowed = shipped.select(other.alias("path"), F.when(F.col("doc_id") % 10 == 0, "changed").otherwise(F.col("sha256")).alias("sha256"), F.lit("approved").alias("decision"))
    return gate.allowlist_findings(allowed, shipped.select("path", "sha256")).select("entity_key", "rule")


@query("""
WITH p AS (SELECT source AS v, doc_id || CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE '' END AS n, CASE WHEN doc_id % 6 = 0 THEN 'old' ELSE sha256(text) END AS sha FROM documents), f AS (SELECT source AS v, CAST(doc_id AS VARCHAR) AS n, sha256(text) AS sha FROM documents)
SELECT coalesce(p.v, f.v) || '/' || coalesce(p.n, f.n) AS entity_key, CASE WHEN f.n IS NULL THEN 'source_missing' WHEN p.n IS NULL THEN 'source_unpinned' ELSE 'source_changed' END AS rule FROM p FULL OUTER JOIN f ON p.v = f.v AND p.n = f.n WHERE p.n IS NULL OR f.n IS NULL OR p.sha <> f.sha""")
def source_pins(spark, sf_dir):
    files = documents(spark, sf_dir).select("doc_id", F.col("source").alias("volume"), F.col("doc_id").cast("string").alias("name"), F.sha2("text", 256).alias("sha256"))
    pins = files.select("volume", F.concat("name", F.when(F.col("doc_id") % 5 == 0, "x").otherwise("")).alias("name"), F.when(F.col("doc_id") % 6 == 0, "old").otherwise(F.col("sha256")).alias("sha256"))
    return gate.pin_findings(pins, files.drop("doc_id")).select("entity_key", "rule")


FLAGS = ["editorial_text_review", "doc_pdf_edition_check", "jurisdiction_distribution_review", "human_final_approval", "illustrations_and_ole_review", "rights_and_third_party_art_review"]


def approval(spark, flags, media_scope="reviewed", pdfs="link", volumes=(1, 2), url="https://example.org/pdf"):
    schema = ", ".join(f"{f} boolean" for f in FLAGS) + ", release_scope struct<media:string,pdfs:string,volumes:array<int>,canonical_pdf_url:string>"
    return spark.createDataFrame([(*flags, (media_scope, pdfs, list(volumes), url))], schema)


# every document is an approval, with flags and scope by its id
@query("""
WITH a AS (SELECT doc_id, ['none', 'reviewed', 'all', 'bad'][doc_id % 4 + 1] AS media, ['link', 'ship', 'other'][doc_id % 3 + 1] AS pdfs, doc_id % 5 = 0 AS empty, doc_id % 7 = 0 AS plain FROM documents),
f AS (SELECT *, (CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END) + (CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END) + (CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END) + (CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END)
  + (CASE WHEN media <> 'none' AND doc_id % 6 = 0 THEN 1 ELSE 0 END) + (CASE WHEN (media <> 'none' OR pdfs <> 'link') AND doc_id % 7 = 0 THEN 1 ELSE 0 END)
  + (CASE WHEN media = 'bad' THEN 1 ELSE 0 END) + (CASE WHEN pdfs = 'other' THEN 1 ELSE 0 END) + (CASE WHEN empty THEN 1 ELSE 0 END) + (CASE WHEN pdfs = 'link' AND plain THEN 1 ELSE 0 END) AS n FROM a)
SELECT sum(n) = 0 AS ok, CAST(sum(n) AS BIGINT) AS n_reasons, CAST(0 AS BIGINT) AS n_notes FROM f""")
def gate_verdict(spark, sf_dir):
    flags = [(F.col("doc_id") % (i + 2) != 0).alias(f) for i, f in enumerate(FLAGS)]
    pick = lambda values: F.get(F.array(*map(F.lit, values)), (F.col("doc_id") % len(values)).cast("int"))
    volumes = F.when(F.col("doc_id") % 5 == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(1)))
    url = F.when(F.col("doc_id") % 7 == 0, "http://example.org").otherwise("https://example.org/pdf")
    given = documents(spark, sf_dir).select(*flags, F.struct(pick(["none", "reviewed", "all", "bad"]).alias("media"), pick(["link", "ship", "other"]).alias("pdfs"), volumes.alias("volumes"), url.alias("canonical_pdf_url")).alias("release_scope"))
    return gate.verdict(gate.flag_findings(given).unionByName(gate.scope_findings(given)))


@query("SELECT CAST(doc_id % 6 + 1 AS INTEGER) AS volume, count(*) AS n_items, count(*) FILTER (WHERE quality = 1) AS n_verified, count(*) FILTER (WHERE quality IS DISTINCT FROM 1) AS n_pending FROM labels GROUP BY 1")
def review_queue_totals(spark, sf_dir):
    queue = spark.read.parquet(f"{sf_dir}/labels.parquet").select((F.col("doc_id") % 6 + 1).cast("int").alias("volume"), F.when(F.col("quality") == 1, "verified").otherwise("pending").alias("human_review_status"))
    return gate.queue_totals(queue)


# records and files with every kind of fault, by the id
@query(f"""WITH {STAGED},
r AS (SELECT doc_id AS id, status, CASE WHEN status = 'published' AND doc_id % 11 <> 0 OR status = 'metadata_only_rights' AND doc_id % 13 = 0 THEN 'm/' || doc_id END AS path, CASE WHEN doc_id % 17 = 0 THEN 'bad' ELSE sha END AS sha,
  CASE WHEN status = 'duplicate' THEN CASE WHEN doc_id % 7 = 0 THEN -1 WHEN doc_id % 5 = 0 THEN doc_id ELSE canonical_id END END AS canon FROM s),
g AS (SELECT 'm/' || doc_id AS path, sha FROM s WHERE status = 'published' AND doc_id % 19 <> 0 UNION ALL SELECT 's/' || doc_id, sha FROM s WHERE doc_id % 23 = 0),
p AS (SELECT r.*, g.sha AS found FROM r LEFT JOIN g ON g.path = r.path WHERE status = 'published'),
n(rule, n) AS (
  SELECT 'ids_are_unique', count(*) FROM (SELECT id FROM r GROUP BY id HAVING count(*) > 1)
  UNION ALL SELECT 'published_has_path', count(*) FROM p WHERE path IS NULL UNION ALL SELECT 'published_file_exists', count(*) FROM p WHERE found IS NULL UNION ALL SELECT 'published_hash_matches', count(*) FROM p WHERE found <> sha
  UNION ALL SELECT 'duplicate_has_canonical', count(*) FROM r WHERE status = 'duplicate' AND canon NOT IN (SELECT id FROM r) UNION ALL SELECT 'no_duplicate_of_duplicate', count(*) FROM r JOIN r c ON c.id = r.canon WHERE r.status = 'duplicate' AND c.status = 'duplicate'
  UNION ALL SELECT 'unpublished_ships_nothing', count(*) FROM r WHERE status NOT IN ('published', 'duplicate') AND path IS NOT NULL UNION ALL SELECT 'no_stray_files', count(*) FROM g WHERE path NOT IN (SELECT path FROM r WHERE path IS NOT NULL)
  UNION ALL SELECT 'status_is_known', count(*) FROM r WHERE status NOT IN ('published', 'duplicate', 'metadata_only_rights', 'decorative_excluded'))
SELECT rule, n = 0 AS ok, CAST(n AS VARCHAR) AS detail FROM n""")
def media_layer_checks(spark, sf_dir):
    rows, id_ = staged(spark, sf_dir), F.col("doc_id")
    own = F.concat(F.lit("m/"), id_.cast("string"))
    path = F.when((F.col("publication_status") == "published") & (id_ % 11 != 0) | (F.col("publication_status") == "metadata_only_rights") & (id_ % 13 == 0), own)
    canon = F.when(F.col("publication_status") == "duplicate", F.when(id_ % 7 == 0, -1).when(id_ % 5 == 0, id_).otherwise(F.col("duplicate_of")))
    records = rows.select(id_.alias("figure_id"), "publication_status", path.alias("public_path"), F.when(id_ % 17 == 0, "bad").otherwise(F.col("sha")).alias("public_asset_sha256"), canon.alias("duplicate_of"))
    files = rows.where("publication_status = 'published' AND doc_id % 19 <> 0").select(own.alias("path"), F.col("sha").alias("sha256"))
    stray = rows.where("doc_id % 23 = 0").select(F.concat(F.lit("s/"), id_.cast("string")).alias("path"), F.col("sha").alias("sha256"))
    return audit.media_findings(records, files.unionByName(stray)).select("rule", "ok", "detail")


@query(f"WITH {STAGED} SELECT source, status AS publication_status, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM s WHERE status NOT IN ('published', 'duplicate') GROUP BY 1, 2")
def owner_action_groups(spark, sf_dir):
    return catalog.action_groups(staged(spark, sf_dir), ["source", "publication_status"], F.octet_length("text"))


@query("""
SELECT 'text_hash_mismatch' AS rule, CAST(doc_id AS VARCHAR) AS entity_key FROM documents WHERE doc_id % 100 = 7
UNION ALL SELECT 'page_out_of_range', CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 500 > 464 OR doc_id % 500 < 1""")
def structural_validation(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = docs.select(F.col("doc_id").alias("section_id"), "text", F.when(F.col("doc_id") % 100 == 7, "wrong").otherwise(F.sha2("text", 256)).alias("sha256"), F.col("doc_id").alias("reading_order"), (F.col("doc_id") % 500).alias("page"), F.lit(464).alias("pdf_pages"))
    chunked = sections.chunks(docs, separator="\n").withColumnRenamed("doc_id", "section_id")
    return audit.section_findings(rows, chunked).select("rule", "entity_key")


@query(r"SELECT doc_id, regexp_replace(lower(substring(text, strpos(text, chr(10)) + 1)), '[^\p{L}\p{N}]', '', 'g') <> '' AS has_words FROM documents WHERE strpos(text, chr(10)) > 0")
def text_behind_title(spark, sf_dir):
    rows = documents(spark, sf_dir).where("instr(text, chr(10)) > 0")
    behind = F.expr("substring(text, instr(text, chr(10)) + 1)")
    return rows.select("doc_id", (F.regexp_replace(F.lower(behind), r"[^\p{L}\p{N}]", "") != "").alias("has_words"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents),
n AS (SELECT doc_id, line_no, trim(regexp_replace(regexp_replace(line, '[#>*`_~]', '', 'g'), '\s+', ' ', 'g')) AS norm FROM l)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, sha256(norm) AS sha FROM n WHERE norm <> ''""")
def line_index(spark, sf_dir):
    return volumes.line_index(documents(spark, sf_dir), "doc_id").select("doc_id", "line_no", F.sha2("norm", 256).alias("sha"))


@query("SELECT source AS work_id, coalesce(min(CASE WHEN lang = 'de' THEN doc_id END), min(doc_id)) AS section_id FROM documents GROUP BY source")
def opening_sections(spark, sf_dir):
    rows = documents(spark, sf_dir).select(F.col("source").alias("work_id"), F.col("doc_id").alias("reading_order"), F.col("doc_id").alias("path"), F.when(F.col("lang") == "de", "opening").otherwise("section").alias("kind"))
    return volumes.opening_section(rows).withColumnRenamed("path", "section_id")


@query(f"WITH {STAGED} SELECT 'publication_status' AS dimension, status AS name, count(*) AS n FROM s GROUP BY status UNION ALL SELECT 'provenance_class', CASE WHEN third THEN 'third_party' ELSE 'authorial' END, count(*) FROM s WHERE labelled GROUP BY 2")
def figure_counts(spark, sf_dir):
    rows = staged(spark, sf_dir).withColumn("provenance_class", F.when(F.col("toxic").isNotNull(), F.when(F.col("third"), "third_party").otherwise("authorial")))
    return volumes.figure_counts(rows)


@query("""
WITH f AS (SELECT source, doc_id || '.md' AS path, sha256(text) AS sha FROM documents WHERE doc_id % 10 <> 3),
l4 AS (SELECT source, left(sha256(path), 4) AS node, sha256(string_agg(path || ' ' || sha, chr(10) ORDER BY path, sha)) AS sha FROM f GROUP BY ALL),
l2 AS (SELECT source, left(node, 2) AS node, sha256(string_agg(l4.node || ' ' || sha, chr(10) ORDER BY l4.node)) AS sha FROM l4 GROUP BY source, left(l4.node, 2)),
l0 AS (SELECT source, sha256(string_agg(node || ' ' || sha, chr(10) ORDER BY node)) AS sha FROM l2 GROUP BY source),
q AS (SELECT d.source, count(*) FILTER (WHERE l.quality = 1) AS v, count(*) FILTER (WHERE l.quality IS DISTINCT FROM 1) AS p FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY d.source)
SELECT d.source AS volume, count(*) FILTER (WHERE doc_id % 10 <> 3) AS n_files, CAST(sum(CASE WHEN doc_id % 10 <> 3 THEN strlen(text) ELSE 0 END) AS BIGINT) AS bytes, count(*) FILTER (WHERE doc_id % 10 = 3) AS n_excluded, coalesce(max(q.v), 0) AS n_verified, coalesce(max(q.p), 0) AS n_pending, max(l0.sha) AS tree_sha256
FROM documents d LEFT JOIN q ON q.source = d.source LEFT JOIN l0 ON l0.source = d.source GROUP BY d.source""")
def release_manifest(spark, sf_dir):
    docs = documents(spark, sf_dir)
    files = docs.select(F.col("source").alias("volume"), F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), F.octet_length("text").cast("bigint").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").join(docs.select("doc_id", "source"), "doc_id")
    queue = labels.select(F.col("source").alias("volume"), F.when(F.col("quality") == 1, "verified").otherwise("pending").alias("human_review_status"))
    return volumes.release_manifest(files, queue, [r"3\.md$"])


@query("""
WITH r AS (SELECT source AS work_id, CAST(doc_id AS VARCHAR) AS file FROM documents), b AS (SELECT d.source AS work_id, CAST(d.doc_id AS VARCHAR) AS file, bool_and(l.toxic = 1) AS blocked FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY 1, 2)
SELECT work_id, file FROM b WHERE blocked""")
def blocked_references(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", F.col("source").alias("work_id"), F.col("doc_id").cast("string").alias("file"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").join(docs, "doc_id")
    records = labels.select("work_id", F.col("file").alias("media_file"), F.lit(None).cast("string").alias("original_filename"), F.col("doc_id").alias("figure_id"), (F.col("toxic") == 1).alias("is_blocked"))
    return volumes.blocked_references(docs.select("work_id", "file"), records)


@query(CHUNKS + """, k AS (SELECT doc_id, sum(end_char - start_char) AS n FROM c WHERE NOT (doc_id % 10 = 0 AND n = 1) GROUP BY doc_id)
SELECT d.source AS volume, count(*) AS n_sections, CAST(sum(coalesce(length(d.text), 0)) AS BIGINT) AS n_chars, count(*) FILTER (WHERE d.doc_id % 3 = 0) AS n_footnotes, CAST(sum(coalesce(k.n, 0)) AS BIGINT) = sum(coalesce(length(d.text), 0)) AS is_lossless
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.source""")
def quality_records(spark, sf_dir):
    """Of chunks of which every tenth document's second is lost; every third document has a note."""
    docs = documents(spark, sf_dir)
    parts = damaged(spark, sf_dir).withColumnRenamed("doc_id", "section_id")
    rows = docs.select(F.col("doc_id").alias("section_id"), F.col("source").alias("volume"), "text")
    notes = docs.where("doc_id % 3 = 0").select(F.col("source").alias("volume"), F.col("doc_id").alias("n"))
    return volumes.quality_record(rows, parts, notes).drop("n_chunks")
