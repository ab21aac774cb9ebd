"""Queries over the registry of figures, on the tables of the driver: documents, conversations and pages are three sources of objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators import figures, placement
from .section_plans import TITLE, documents

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# each source has captions and contexts of its own; the first word of a text stands for an object's bytes, so that many are equal
def _feeders(spark, sf_dir):
    word = lambda c: F.sha2(F.lower(F.regexp_extract(c, r"([A-Za-z]+)", 1)), 256)
    docs = documents(spark, sf_dir).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("figure_id"), F.col("source").alias("work_id"), text.title_of(F.col("text")).alias("caption"), F.coalesce(F.get(F.split("text", "\n"), F.lit(1)), F.lit("")).alias("context_excerpt"),
        F.when(F.col("lang").isin("de", "fr"), ".emf").otherwise(".png").alias("ext"), word(F.col("text")).alias("source_sha256"), F.length("text").cast("bigint").alias("media_bytes"), (F.length("text") % 2 == 0).alias("referenced_in_text"),
        F.lit(0).alias("seat_feeder"), F.lit(0).alias("seat_phase"), F.length("text").alias("seat_place"), F.lit(True).alias("may_repeat"),
    )
    turns = _table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("figure_id"), F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("work_id"), text.title_of(F.col("text")).alias("caption"),
        F.col("role").alias("context_excerpt"), F.when(F.col("role") == "assistant", ".wmf").otherwise(".jpg").alias("ext"), word(F.col("text")).alias("source_sha256"), F.length("text").cast("bigint").alias("media_bytes"), (F.col("role") != "user").alias("referenced_in_text"),
        F.lit(1).alias("seat_feeder"), (F.col("role") != "user").cast("int").alias("seat_phase"), F.col("turn").alias("seat_place"), F.lit(True).alias("may_repeat"),
    )
    pages = _table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("figure_id"), F.regexp_extract("url", "//([^/]+)", 1).alias("work_id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("caption"), F.lit("").alias("context_excerpt"),
        F.lit(".bin").alias("ext"), word(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("source_sha256"), F.length("html").cast("bigint").alias("media_bytes"), F.lit(False).alias("referenced_in_text"),
        F.lit(1).alias("seat_feeder"), F.lit(2).alias("seat_phase"), F.lit(0).alias("seat_place"), F.lit(False).alias("may_repeat"),
    )
    return docs.unionByName(turns).unionByName(pages).withColumns({"figure_label": F.lit(None).cast("string"), "original_filename": F.lit("x")})


_KIND = " ".join(f"WHEN contains(lower(caption), '{word}') THEN '{kind}'" for word, kind in fixed.MEDIA_KEYWORDS)
_VECTOR = ", ".join(f"'{x}'" for x in fixed.VECTOR)
_RASTER = ", ".join(f"'{x}'" for x in fixed.RASTER)


@query(rf"""
WITH f AS (
  SELECT 'd' || doc_id AS figure_id, source AS work_id, {TITLE} AS caption, coalesce(string_split(text, chr(10))[2], '') AS context, CASE WHEN lang IN ('de', 'fr') THEN '.emf' ELSE '.png' END AS ext,
    sha256(lower(regexp_extract(text, '([A-Za-z]+)', 1))) AS sha, length(text) AS size, length(text) % 2 = 0 AS referenced, 0 AS feeder, 0 AS phase, length(text) AS place, true AS may_repeat FROM documents
  UNION ALL SELECT 'c' || conv_id || '-' || turn, 'conv' || conv_id, {TITLE}, role, CASE WHEN role = 'assistant' THEN '.wmf' ELSE '.jpg' END, sha256(lower(regexp_extract(text, '([A-Za-z]+)', 1))), length(text), role <> 'user', 1, CASE WHEN role <> 'user' THEN 1 ELSE 0 END, turn, true FROM conversations
  UNION ALL SELECT 'p' || page_id, regexp_extract(url, '//([^/]+)', 1), regexp_extract(html, '<title>([^<]*)</title>', 1), '', '.bin', sha256(lower(regexp_extract(regexp_extract(html, '<title>([^<]*)</title>', 1), '([A-Za-z]+)', 1))), length(html), false, 1, 2, 0, false FROM pages
), k AS (SELECT *, CASE {_KIND} WHEN ext IN ({_VECTOR}) THEN 'scheme' ELSE 'other' END AS media_type FROM f),
r AS (SELECT *, CASE WHEN regexp_matches(concat_ws(' ', caption, context), '(?i){fixed.THIRD_PARTY}') OR media_type IN ('photo', 'reproduction', 'map', 'cover') THEN 'rights_review_required'
  WHEN ext IN ({_VECTOR}) OR media_type IN ('scheme', 'diagram', 'chart', 'table_image') THEN 'authorial' ELSE 'unknown' END AS rights_status,
  CASE WHEN size < 2048 OR media_type = 'decorative' THEN 'decorative' WHEN ext IN ({_VECTOR}) OR media_type IN ('scheme', 'diagram', 'chart') THEN 'critical_for_understanding' WHEN media_type IN ('map', 'reproduction', 'photo') THEN 'useful' ELSE 'unclear' END AS criticality FROM k),
s AS (SELECT *, CASE WHEN rights_status IN ('rights_review_required', 'unknown') THEN 'metadata_only_rights' WHEN criticality = 'decorative' AND NOT referenced THEN 'decorative_excluded' WHEN ext IN ({_RASTER}, {_VECTOR}) THEN 'published' ELSE 'technical_failure' END AS status,
  first_value(figure_id) OVER w AS canon FROM r WINDOW w AS (PARTITION BY sha ORDER BY feeder, work_id, phase, place, figure_id)),
t AS (SELECT s.*, c.status AS canon_status FROM s JOIN s c ON c.figure_id = s.canon)
SELECT figure_id, media_type, rights_status, criticality, CASE WHEN canon <> figure_id AND may_repeat THEN 'duplicate' ELSE status END AS publication_status, CASE WHEN canon <> figure_id THEN canon END AS duplicate_of,
  CASE WHEN canon <> figure_id AND may_repeat AND canon_status <> 'published' THEN canon_status END AS duplicate_blocked_by,
  CASE WHEN canon <> figure_id AND may_repeat THEN CASE WHEN canon_status = 'published' THEN canon END WHEN status = 'published' THEN figure_id END AS asset_of FROM t""")
def figure_registry(spark, sf_dir):
    rows = _feeders(spark, sf_dir)
    rows = figures.judged(rows, F.col("ext"), F.col("media_bytes"), F.lit(None).cast("int"))
    found = figures.elect(figures.shaped(rows))
    return found.select("figure_id", "media_type", "rights_status", "criticality", "publication_status", "duplicate_of", "duplicate_blocked_by", "asset_of")


_NAME = "lang || doc_id || '.doc'"


@query(f"""
WITH d AS (SELECT doc_id, lang, length(text) AS n, sha256({TITLE}) AS sha, {_NAME} AS name FROM documents),
l AS (SELECT d.*, l.quality, l.toxic FROM d JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
one AS (SELECT sha, arg_max(doc_id, doc_id) AS id FROM l WHERE quality = 1 AND doc_id % 3 = 0 GROUP BY sha), two AS (SELECT sha, arg_max(name, doc_id) AS name FROM l WHERE toxic = 1 OR quality = 0 GROUP BY sha),
f AS (SELECT 'site_docx/' || name || 'x' AS path FROM d WHERE n % 2 = 0 UNION SELECT 'repaired/' || name || 'x' FROM d WHERE n % 3 = 0 UNION SELECT 'site_files/' || name FROM d WHERE n % 5 = 0),
t AS (SELECT d.doc_id AS work_id, 'docx/' || one.id || '.docx' AS a, 'site_docx/' || two.name || 'x' AS b, 'site_files/' || two.name AS c, CASE WHEN d.n % 7 > 1 THEN 'repaired/' || d.name || 'x' END AS e, CASE WHEN d.n % 7 > 1 THEN 'site_files/' || d.name END AS g,
  one.id IS NOT NULL AS is_a, two.name IS NOT NULL AS is_c FROM d LEFT JOIN one ON one.sha = d.sha LEFT JOIN two ON two.sha = d.sha)
SELECT work_id, CASE WHEN is_a THEN 'conversion log' WHEN is_c AND b IN (SELECT path FROM f) THEN 'classified log, converted' WHEN is_c THEN 'classified log, as found' WHEN e IN (SELECT path FROM f) THEN 'name, repaired' WHEN g IN (SELECT path FROM f) THEN 'name, as found' END AS level,
  CASE WHEN is_a THEN a WHEN is_c AND b IN (SELECT path FROM f) THEN b WHEN is_c THEN c WHEN e IN (SELECT path FROM f) THEN e WHEN g IN (SELECT path FROM f) THEN g END AS source_path,
  CASE WHEN is_a OR (is_c AND b IN (SELECT path FROM f)) OR (NOT is_c AND e IN (SELECT path FROM f)) THEN 'docx' WHEN is_c OR g IN (SELECT path FROM f) THEN 'doc' END AS source_kind FROM t""")
def source_resolution(spark, sf_dir):
    n, name = F.length("text"), F.concat("lang", F.col("doc_id").cast("string"), F.lit(".doc"))
    docs = documents(spark, sf_dir).select("doc_id", n.alias("n"), F.sha2(text.title_of(F.col("text")), 256).alias("sha256"), name.alias("name"))
    labels = docs.join(_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")), "doc_id")
    works = docs.select(F.col("doc_id").alias("work_id"), F.col("sha256").alias("sha256_source"), F.concat(F.when(F.col("n") % 7 > 1, "site:").otherwise("other:"), "name").alias("source_name"))
    converted = labels.where("quality = 1 AND doc_id % 3 = 0").select(F.col("doc_id").alias("line_no"), "sha256", F.col("doc_id").cast("string").alias("id"))
    classified = labels.where("toxic = 1 OR quality = 0").select(F.col("doc_id").alias("line_no"), "sha256", F.col("name").alias("file"), F.lit("doc").alias("ext"))
    path = lambda folder, every, end: docs.where(F.col("n") % every == 0).select(F.concat(F.lit(folder), "name", F.lit(end)).alias("path"))
    files = path("site_docx/", 2, "x").unionByName(path("repaired/", 3, "x")).unionByName(path("site_files/", 5, ""))
    return figures.resolve_sources(works, converted, classified, files).select("work_id", "level", "source_path", "source_kind")


# figures of a document: one for each label, anchored at a line of its text by hash, some of them three lines off; toxic ones may not be shown
_SQUEEZED = r"trim(regexp_replace(regexp_replace(replace({0}, chr(173), ''), '[#>*`_~]', '', 'g'), '\s+', ' ', 'g'))"


@query(rf"""
WITH d AS (SELECT doc_id, text, CASE WHEN text LIKE '%' || chr(10) THEN string_split(left(text, length(text) - 1), chr(10)) ELSE string_split(text, chr(10)) END AS own FROM documents WHERE coalesce(text, '') <> ''),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
a AS (SELECT d.doc_id, own, toxic, quality, length(text) % len(own) AS spot, 'f' || d.doc_id AS id FROM d JOIN l ON l.doc_id = d.doc_id),
n AS (SELECT doc_id, own, id, toxic, quality, spot, CASE WHEN doc_id % 3 = 0 THEN spot + 3 ELSE spot END AS told, list_transform(own, lambda x: {_SQUEEZED.format('x')}) AS norm FROM a),
h AS (SELECT *, list_filter(range(len(own)), lambda i: norm[i + 1] = norm[spot + 1]) AS hits FROM n),
p AS (SELECT *, list_min(list_transform(list_filter(hits, lambda i: abs(i - told) <= 40), lambda i: {{'far': abs(i - told), 'i': i}})).i AS place FROM h),
b AS (SELECT doc_id, own, CASE WHEN quality = 1 AND toxic = 0 THEN place - 1 ELSE place END AS place,
  ['', CASE WHEN toxic = 1 THEN '{fixed.OMITTED_ONE.format(label="")} <!-- figs:' || id || ' -->' ELSE '![figure ' || doc_id || '](media/' || doc_id || '.png)<!-- figs:' || id || ' -->' END, ''] AS block FROM p),
t AS (SELECT d.doc_id, array_to_string(CASE WHEN b.doc_id IS NULL THEN d.own ELSE list_concat(list_concat(d.own[1 : b.place + 1], b.block), d.own[b.place + 2 :]) END, chr(10)) || chr(10) AS done FROM d LEFT JOIN b ON b.doc_id = d.doc_id)
SELECT doc_id, sha256(done) AS once_sha256, sha256(done) AS twice_sha256, sha256(done) AS in_parts_sha256 FROM t""")
def figure_placement(spark, sf_dir):
    id_, shown, at = F.col("doc_id").cast("string"), F.col("toxic") == 0, F.col("at")
    docs = documents(spark, sf_dir).select("doc_id", "text", F.concat(F.lit("texts/"), id_).alias("file"))
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    own = F.split(F.when(F.endswith("text", F.lit("\n")), F.substring("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text")), "\n")
    spots = docs.where(F.coalesce("text", F.lit("")) != "").select("doc_id", "file", F.length("text").alias("n"), own.alias("own")).withColumn("at", (F.col("n") % F.size("own")).cast("int"))
    spots = spots.select("doc_id", "file", "at", F.sha2(text.squeeze(F.get("own", at)), 256).alias("sha"))  # what goes into the join is short
    records = spots.join(labels, "doc_id").select(
        F.concat(F.lit("f"), id_).alias("figure_id"), F.col("file").alias("anchor_file"), F.when(F.col("doc_id") % 3 == 0, at + 3).otherwise(at).alias("anchor_line"), F.col("sha").alias("anchor_sha256"),
        F.when(shown & (F.col("quality") == 1), "before").otherwise("after").alias("anchor_mode"), F.lit("anchor_exact").alias("anchor_confidence"), F.lit("fb2_embedded").alias("source_kind"), F.lit(True).alias("referenced_in_text"),
        F.when(shown, "published").otherwise("metadata_only_rights").alias("publication_status"), F.when(shown, F.concat(F.lit("texts/media/"), id_, F.lit(".png"))).alias("shipped"), F.concat(F.lit("figure "), id_).alias("caption"),
        F.lit(None).cast("string").alias("figure_label"), F.lit(None).cast("string").alias("original_filename"),
    )

    # each text twice: all figures at once, and again; a part of them first, and all later
    digest, none = F.sha2("text", 256), F.lit(None).cast("string")
    once = placement.placed_texts(docs, records)[0].withColumn("once_sha256", digest)
    twice = placement.placed_texts(once, records)[0].select("doc_id", "once_sha256", digest.alias("twice_sha256"), none.alias("in_parts_sha256"))
    part = placement.placed_texts(docs, records.where("pmod(xxhash64(figure_id), 2) = 0"))[0]
    in_parts = placement.placed_texts(part, records)[0].select("doc_id", none.alias("once_sha256"), none.alias("twice_sha256"), digest.alias("in_parts_sha256"))
    return twice.unionByName(in_parts).groupBy("doc_id").agg(*[F.max(c).alias(c) for c in ("once_sha256", "twice_sha256", "in_parts_sha256")])
