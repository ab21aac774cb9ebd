"""Queries over sections, chunks and search, on the tables of the driver: a document is a section, its source a work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup, paths, text
from ..operators import search, sections

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
SEARCH = "the tion"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


TITLE = r"coalesce(split_part(text, chr(10), 1), '')"


@query(f"""
WITH s AS (SELECT doc_id AS section_id, lower({TITLE}) AS h, lower({TITLE}) || ' ' || lower(substring(text, 1, 480)) AS hay, substring(text, 1, 380) AS snippet FROM documents)
SELECT section_id, CAST((CASE WHEN contains(h, 'the') THEN 10 ELSE 1 END) + (CASE WHEN contains(h, 'tion') THEN 10 ELSE 1 END) AS INTEGER) AS score, snippet
FROM s WHERE contains(hay, 'the') AND contains(hay, 'tion') ORDER BY score DESC, section_id LIMIT 50""")
def search_topk(spark, sf_dir):
    found = search.search(search.index(sections.sections(documents(spark, sf_dir))), SEARCH)
    return found.select("section_id", "score", "snippet")


@query(rf"""
WITH q AS (SELECT 2 * item_id AS query_id, list_filter(regexp_split_to_array(lower(trim(array_to_string(string_split(text, ' ')[1:3], ' '))), '\s+'), lambda w: w <> '') AS words FROM benchmark
  UNION ALL SELECT 2 * item_id + 1, list_filter(regexp_split_to_array(lower(trim(text)), '\s+'), lambda w: w <> '') FROM benchmark),
s AS (SELECT doc_id, lower({TITLE}) AS head, lower({TITLE}) || ' ' || lower(coalesce(substring(text, 1, 480), '')) AS hay FROM documents),
m AS (SELECT query_id, doc_id AS section_id, CAST(list_sum(list_transform(words, lambda w: CASE WHEN contains(head, w) THEN 10 ELSE 1 END)) AS INTEGER) AS score
  FROM q JOIN s ON len(list_filter(words, lambda w: NOT contains(hay, w))) = 0 WHERE len(words) > 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, section_id) AS INTEGER) AS rank FROM m)
SELECT query_id, rank, section_id, score FROM r WHERE rank <= 50""")
def search_many(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    begun = F.array_join(F.slice(F.split("text", " "), 1, 3), " ")
    queries = items.select((2 * F.col("item_id")).alias("query_id"), begun.alias("query")).unionByName(items.select((2 * F.col("item_id") + 1).alias("query_id"), F.col("text").alias("query")))
    return search.search_all(search.index(sections.sections(documents(spark, sf_dir))), queries)


@query(f"SELECT {TITLE} AS title, 'section' AS kind, source AS work_id, doc_id AS section_id, '/' || source || '/' || doc_id || '.html' AS url, substring(text, 1, 480) AS text FROM documents")
def search_index(spark, sf_dir):
    return search.index(sections.sections(documents(spark, sf_dir)))


# chunks: line ends stand for blank lines, which the tables lack
CHUNKS = r"""
WITH RECURSIVE c(doc_id, text, n, start_char, end_char) AS (
  SELECT doc_id, text, 0, 0, CASE WHEN length(text) <= 3200 THEN length(text) ELSE
    CASE WHEN strpos(reverse(substring(text, 1201, 2000)), chr(10)) > 0 THEN 3200 - strpos(reverse(substring(text, 1201, 2000)), chr(10)) + 1 ELSE 3200 END END
  FROM documents WHERE text <> ''
  UNION ALL
  SELECT doc_id, text, n + 1, end_char, CASE WHEN length(text) <= end_char + 3200 THEN length(text) ELSE
    CASE WHEN strpos(reverse(substring(text, CAST(end_char + 1201 AS BIGINT), 2000)), chr(10)) > 0 THEN end_char + 3200 - strpos(reverse(substring(text, CAST(end_char + 1201 AS BIGINT), 2000)), chr(10)) + 1 ELSE end_char + 3200 END END
  FROM c WHERE end_char < length(text)
)"""


@query(CHUNKS + " SELECT doc_id, CAST(n AS INTEGER) AS chunk_no, CAST(start_char AS INTEGER) AS start_char, CAST(end_char AS INTEGER) AS end_char, sha256(substring(text, CAST(start_char + 1 AS BIGINT), CAST(end_char - start_char AS BIGINT))) AS sha FROM c")
def chunk_ranges(spark, sf_dir):
    found = sections.chunks(documents(spark, sf_dir), separator="\n")
    return found.select("doc_id", "chunk_no", "start_char", "end_char", F.sha2("text", 256).alias("sha"))


def damaged(spark, sf_dir):
    """Chunks of all documents; of every tenth the second is lost, of the one behind it the third begins a character late."""
    found = sections.chunks(documents(spark, sf_dir), separator="\n")
    late = (F.col("doc_id") % 10 == 1) & (F.col("chunk_no") == 2)
    return found.where("NOT (doc_id % 10 = 0 AND chunk_no = 1)").withColumn("start_char", F.col("start_char") + late.cast("int"))


DAMAGED = CHUNKS + """, m AS (SELECT doc_id, n, start_char + CASE WHEN doc_id % 10 = 1 AND n = 2 THEN 1 ELSE 0 END AS a, end_char AS b, substring(text, CAST(start_char + 1 AS BIGINT), CAST(end_char - start_char AS BIGINT)) AS part
  FROM c WHERE NOT (doc_id % 10 = 0 AND n = 1))"""


@query(DAMAGED + """, g AS (SELECT doc_id, CASE WHEN a <> lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY n) OR b - a <> length(part) THEN 1 ELSE 0 END AS gap FROM m)
SELECT doc_id, count(*) AS n_chunks, CAST(sum(gap) AS BIGINT) AS n_gaps FROM g GROUP BY doc_id""")
def chunk_contiguity(spark, sf_dir):
    return sections.contiguity(damaged(spark, sf_dir))


@query(DAMAGED + """, w AS (SELECT doc_id, string_agg(part, '' ORDER BY n) AS whole FROM m GROUP BY doc_id)
SELECT w.doc_id, sha256(whole) AS sha, whole = d.text AS is_whole FROM w JOIN documents d ON d.doc_id = w.doc_id""")
def chunk_lossless(spark, sf_dir):
    docs = documents(spark, sf_dir)
    whole = sections.rejoined(damaged(spark, sf_dir), "doc_id", "chunk_no", "text")
    return whole.join(docs.select("doc_id", F.sha2("text", 256).alias("own")), "doc_id").select("doc_id", F.sha2("whole", 256).alias("sha"), (F.sha2("whole", 256) == F.col("own")).alias("is_whole"))


@query(rf"SELECT doc_id, regexp_replace(replace(replace(lower({TITLE}), 'ё', 'е'), chr(173), ''), '[^\p{{L}}\p{{N}}_]+', ' ', 'g') AS norm FROM documents")
def section_titles_norm(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.norm_search(text.title_of(F.col("text"))).alias("norm"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(replace(text, chr(173), ''), '[#>*`_~]', '', 'g'), '\s+', ' ', 'g'))) AS sha FROM documents")
def norm_whitespace(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.sha2(text.squeeze(F.col("text")), 256).alias("sha"))


@query(r"SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\[\^[0-9]+\]', '', 'g'), '\]\([^)]+\)', '', 'g'), '<[^>]+>', '', 'g'), '[*_`#]+', '', 'g')) AS sha FROM (SELECT doc_id, trim(text, ' ' || chr(10) || chr(9)) AS text FROM documents)")
def plain_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.sha2(text.plain(F.col("text")), 256).alias("sha"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents),
r AS (SELECT doc_id, line_no, sum(CASE WHEN line LIKE '%.' THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run_no FROM l)
SELECT doc_id, CAST(run_no AS BIGINT) AS run_no, CAST(min(line_no) AS INTEGER) AS first_line, count(*) AS n_lines FROM r GROUP BY 1, 2""")
def line_sections(spark, sf_dir):
    rows = sections.lines(documents(spark, sf_dir))
    return sections.numbered_runs(rows, "doc_id", "line_no", ~F.col("line").endswith(".")).groupBy("doc_id", "run_no").agg(F.min("line_no").alias("first_line"), F.count(F.lit(1)).alias("n_lines"))


@query("SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations")
def section_navigation(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role")
    return sections.navigation(rows, "conv_id", "turn", "role")


@query("SELECT doc_id AS section_id, source AS work_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS reading_order FROM documents")
def reading_order(spark, sf_dir):
    return sections.in_reading_order(sections.sections(documents(spark, sf_dir)).select("section_id", "work_id"))


@query(f"WITH t AS (SELECT doc_id, {TITLE} AS title FROM documents), c AS (SELECT title, count(*) AS n FROM t GROUP BY title HAVING count(*) > 1) SELECT t.doc_id, t.title, c.n AS n_sections FROM t JOIN c ON t.title = c.title")
def title_collisions(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", text.title_of(F.col("text")).alias("title"))
    return sections.title_collisions(rows, "doc_id")


def _markdown_sql() -> str:
    x = r"coalesce(nullif(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1), ''), html)"
    for tag in ("script", "style", "aside", "nav", "footer", "header"):
        x = rf"regexp_replace({x}, '(?is)<{tag}\b[^>]*>.*?</{tag}>', '', 'g')"
    for level in range(1, 5):
        x = rf"regexp_replace({x}, '(?is)<h{level}\b[^>]*>(.*?)</h{level}>', chr(10) || chr(10) || '{'#' * level} \1' || chr(10) || chr(10), 'g')"
    x = rf"regexp_replace({x}, '(?i)<br\s*/?>', chr(10), 'g')"
    x = rf"regexp_replace({x}, '(?i)</p>', chr(10) || chr(10), 'g')"
    x = rf"regexp_replace({x}, '(?i)<li\b[^>]*>', chr(10) || '- ', 'g')"
    x = rf"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for a, b in markup.ENTITIES:
        x = f"replace({x}, '{a}', '{b if b != chr(39) else chr(39) * 2}')"
    x = rf"regexp_replace({x}, '[ \t]+\n', chr(10), 'g')"
    x = rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    return rf"SELECT page_id, sha256(regexp_replace({x}, '^\s+|\s+$', '', 'g')) AS sha FROM pages"


@query(_markdown_sql())
def html_to_markdown(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.sha2(markup.html_to_markdown(F.col("html")), 256).alias("sha"))


# every document links in one of seven ways; the SQL walks up by striking out a folder and the .. behind it, until none is left
_TARGET = "CASE doc_id % 7 WHEN 0 THEN '../d.md' WHEN 1 THEN './x/../y.md#part' WHEN 2 THEN '../../../z.md' WHEN 3 THEN '/root/r.md?q=1' WHEN 4 THEN 'd/./e.md' WHEN 5 THEN 'p/q/../../../s.md' ELSE 'a%20b/' || source || '.md' END"
_UP = "regexp_replace({0}, '(^|/)(?:[^/.][^/]*|[.][^/.][^/]*)/[.][.](?:/|$)', '\\1')"


@query(rf"""
WITH l AS (SELECT doc_id, source || '/' || lang || '/' || doc_id || '.md' AS base, {_TARGET} AS target FROM documents),
w AS (SELECT *, replace(regexp_replace(target, '[#?].*$', ''), '%20', ' ') AS clean FROM l),
j AS (SELECT *, regexp_replace(CASE WHEN clean LIKE '/%' THEN substring(clean, 2) ELSE regexp_replace(base, '[^/]*$', '') || clean END, '(^|/)[.]/', '\1', 'g') AS p0 FROM w),
u1 AS (SELECT *, {_UP.format('p0')} AS p1 FROM j), u2 AS (SELECT *, {_UP.format('p1')} AS p2 FROM u1), u3 AS (SELECT *, {_UP.format('p2')} AS p3 FROM u2)
SELECT doc_id, target, regexp_replace(p3, '^([.][.]/)+', '') AS resolved, CASE WHEN p3 NOT LIKE '../%' THEN p3 END AS strict FROM u3""")
def link_resolution(spark, sf_dir):
    base = F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))
    rows = documents(spark, sf_dir).select("doc_id", base.alias("base"), F.expr(_TARGET).alias("target"))
    return rows.select("doc_id", "target", paths.resolve(F.col("base"), F.col("target")).alias("resolved"), paths.resolve_strict(F.col("base"), F.col("target")).alias("strict"))


@query("""
WITH r AS (SELECT source AS work, doc_id AS pos, doc_id % 4 = 0 AS is_parent, CASE WHEN doc_id % 3 = 0 THEN 'heading_only' ELSE 'context' END AS status, CAST(doc_id // 10 + doc_id % 9 AS INTEGER) AS page FROM documents),
n AS (SELECT *, sum(CASE WHEN is_parent THEN 1 ELSE 0 END) OVER (PARTITION BY work ORDER BY pos) AS run FROM r),
k AS (SELECT work, run, arg_min(page, pos) AS child FROM n WHERE status = 'context' AND NOT is_parent GROUP BY work, run)
SELECT n.work, n.pos, CASE WHEN is_parent AND status = 'heading_only' AND child BETWEEN page AND page + 6 THEN child ELSE page END AS page FROM n LEFT JOIN k ON k.work = n.work AND k.run = n.run""")
def parent_page_repair(spark, sf_dir):
    status = F.when(F.col("doc_id") % 3 == 0, "heading_only").otherwise("context")
    rows = documents(spark, sf_dir).select(F.col("source").alias("work"), F.col("doc_id").alias("pos"), (F.col("doc_id") % 4 == 0).alias("is_parent"), status.alias("status"), (F.floor(F.col("doc_id") / 10) + F.col("doc_id") % 9).cast("int").alias("page"))
    return sections.repair_parent_pages(rows, "work", "pos").select("work", "pos", "page")


@query(r"""
SELECT doc_id AS section_id, lang AS language, CASE WHEN doc_id % 2 = 0 THEN 'v0.3' ELSE 'v0.4' END AS schema, CASE WHEN doc_id % 2 = 0 THEN source END AS unit_source,
  CASE WHEN doc_id % 2 = 1 THEN CAST(length(text) AS VARCHAR) END AS n_text FROM documents""")
def schema_union_v3_v4(spark, sf_dir):
    docs = documents(spark, sf_dir)
    old = docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("unit_id"), "lang", F.lit("v0.3").alias("schema"), F.col("source").alias("unit_source"))
    new = docs.where("doc_id % 2 = 1").select(F.col("doc_id").alias("section_id"), F.col("lang").alias("language"), F.lit("v0.4").alias("schema"), F.length("text").cast("string").alias("n_text"))
    return sections.union_schemas(old, new, {"unit_id": "section_id", "lang": "language"})


# every document calls two notes and defines two, some of them the same
@query("""
WITH d AS (SELECT doc_id, doc_id % 5 + 1 AS r1, doc_id % 3 + 1 AS r2, doc_id % 4 + 1 AS d1 FROM documents),
r AS (SELECT doc_id, r1 AS n FROM d UNION ALL SELECT doc_id, r2 FROM d), f AS (SELECT doc_id, d1 AS n FROM d UNION ALL SELECT doc_id, 2 FROM d),
x AS (
  SELECT DISTINCT 'block' AS severity, 'undefined_footnote' AS rule, doc_id, n FROM r WHERE (doc_id, n) NOT IN (SELECT (doc_id, n) FROM f)
  UNION ALL SELECT DISTINCT 'note', 'unowned_footnote', doc_id, n FROM f WHERE (doc_id, n) NOT IN (SELECT (doc_id, n) FROM r)
  UNION ALL SELECT 'block', 'duplicate_definition', doc_id, n FROM f GROUP BY doc_id, n HAVING count(*) > 1
  UNION ALL SELECT 'block', 'repeated_reference', doc_id, n FROM r GROUP BY doc_id, n HAVING count(*) > 1)
SELECT severity, rule, CAST(doc_id AS VARCHAR) AS entity_key, CAST(n AS VARCHAR) AS detail FROM x""")
def footnote_partition(spark, sf_dir):
    n = lambda by: (F.col("doc_id") % by + 1).cast("string")
    body = F.concat(F.lit("One[^"), n(5), F.lit("] two[^"), n(3), F.lit("].\n\n[^"), n(4), F.lit("]: first\n[^2]: second\nline\n"))
    return sections.footnote_findings(documents(spark, sf_dir).select("doc_id", body.alias("text")))


@query(r"""
WITH w AS (SELECT doc_id, source, length(regexp_replace(text, '[^\p{L}\p{N}_]', '', 'g')) AS n FROM documents WHERE lang <> 'en')
SELECT doc_id, source, CAST(n AS INTEGER) AS word_chars, CASE WHEN n >= 200 THEN 'full' ELSE 'text_unavailable' END AS full_text_status FROM w""")
def translation_gate(spark, sf_dir):
    from ..functions import fixed

    n = text.word_chars(F.col("text"))
    return documents(spark, sf_dir).where("lang <> 'en'").select("doc_id", "source", n.alias("word_chars"), F.when(n >= fixed.FULL_TEXT_LEAST_WORD_CHARS, "full").otherwise("text_unavailable").alias("full_text_status"))
