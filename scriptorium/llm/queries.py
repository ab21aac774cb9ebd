"""The queries of this subpackage, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, conversation_repair, fingerprints, html_text, lexical_search, merge_automaton, mixing, pieces, simhash, suffix_dedup, token_files, topk, toxicity, word_pieces


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token ids and return where each lies in the files."""
    import public_tokenizers

    path = common.new_path(spark, "token_files")
    token_files.write(common.table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.index(spark, path)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: words taken of each, near the target of its source."""
    return mixing.mix(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.classes(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.edited(common.table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth embedding with all others."""
    rows = topk.quantised(common.table(spark, sf_dir, "embeddings"))
    return topk.search(rows, rows.where(F.col("vec_id") % topk.EVERY == 0))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels outside the held-out fold."""
    docs = common.table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(common.table(spark, sf_dir, "pages"))


def op8_word_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    import public_tokenizers

    return word_pieces.counts(common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids again, and return digests of the ids and whether the text came back."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    back = pieces.round_trip(common.table(spark, sf_dir, "documents"), path)
    return back.select("doc_id", "n_tokens", "ids_crc32", (F.xxhash64("text") == F.col("digest")).alias("round_trip"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of documents with smaller ids."""
    found = suffix_dedup.removals(common.table(spark, sf_dir, "documents"))
    doc_id = F.when(F.col("id") != common.NULL_ID, F.col("id")).alias("doc_id")
    return found.select(doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document by the tokenization automaton, decode the ids again, and return digests of both."""
    import public_tokenizers

    return merge_automaton.digests(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage all conversations, then repair each by the cheapest edits."""
    rows = common.table(spark, sf_dir, "conversations")
    return conversation_repair.audited(rows, conversation_repair.damaged(rows))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for each benchmark item."""
    return lexical_search.ranked(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_pieces": op2_pieces,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_fingerprints": op6_fingerprints,
    "op7_html_text": op7_html_text,
    "op8_word_pieces": op8_word_pieces,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_topk": op10_topk,
    "op11_merge_automaton": op11_merge_automaton,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lexical_search": op13_lexical_search,
}
ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL["op10_topk"] = """
WITH parts AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x, len(embedding) AS dim FROM embeddings
), sound AS (
  SELECT vec_id FROM parts GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))
), e AS (
  SELECT p.vec_id, p.i, p.dim, CAST(floor(256 * CAST(p.x AS DOUBLE)) AS BIGINT) AS v FROM parts p JOIN sound s ON p.vec_id = s.vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.i = c.i AND q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
ORACLE_SQL["op9_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d WHERE n >= 50),
w AS (SELECT doc_id, p, substring(h, 2 * p + 1, 100) AS g FROM p),
m AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT w.doc_id, w.p FROM w JOIN m ON w.g = m.g WHERE m.least < w.doc_id),
i AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS starts FROM r),
k AS (SELECT doc_id, p, sum(starts) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM i),
s AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM k GROUP BY doc_id, run),
e AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_b, b FROM s),
parts AS (SELECT doc_id, from_b AS a, a AS b FROM e UNION ALL SELECT d.doc_id, coalesce(max(s.b), 0), d.n FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id, d.n),
kept AS (SELECT q.doc_id, string_agg(substring(d.h, 2 * q.a + 1, 2 * (q.b - q.a)), '' ORDER BY q.a) AS h FROM parts q JOIN d ON d.doc_id = q.doc_id GROUP BY q.doc_id),
t AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM s GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(t.n_removed, 0) AS n_removed, coalesce(t.n_spans, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""
ORACLE_SQL["op12_conversation_repair"] = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations
), kinds AS (
  SELECT * EXCLUDE (bytes), xor(list_reduce(bytes, lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295), 4294967295) % 20 AS kind FROM src
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, (VALUES (1), (2)) t(copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)
), numbered AS (
  SELECT *, row_number() OVER c AS rn, lag(role) OVER c AS role_before,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM damaged WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), told AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN rn > min(rn) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (rn > 1 AND concat(role_before[1], role[1]) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM told GROUP BY conv_id
), gap(f, t, audit, cost, lines) AS (
  VALUES (0, 0, '', 0, []::VARCHAR[]), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []), (0, 2, 'I', 2, ['user:']), (1, 2, 'I', 2, ['user:']), (3, 2, 'I', 2, ['user:']),
    (2, 3, 'I', 2, ['assistant:']), (0, 3, 'II', 4, ['user:', 'assistant:']), (1, 3, 'II', 4, ['user:', 'assistant:'])
), follows(f, t, initial, role) AS (VALUES (0, 1, 's', 'system'), (0, 2, 'u', 'user'), (1, 2, 'u', 'user'), (3, 2, 'u', 'user'), (2, 3, 'a', 'assistant')),
options AS (
  SELECT f, t, initial AS of, 'K' AS edit, 0 AS cost, NULL AS role FROM follows
  UNION ALL SELECT f, t, NULL, 'R', 2, role FROM follows WHERE initial <> 's'
  UNION ALL SELECT s, s, NULL, 'D', 3, NULL FROM range(4) r(s)
), best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': []::VARCHAR[]} AS way FROM facts
  UNION ALL
  SELECT conv_id, rn, state, way FROM (
    SELECT b.conv_id, r.rn, CAST(o.t AS BIGINT) AS state, min({'cost': CAST(b.way.cost + g.cost + o.cost + CASE WHEN r.fault = 'truncated' AND o.edit <> 'D' THEN 1 ELSE 0 END AS BIGINT),
      'audit': concat(b.way.audit, g.audit, o.edit),
      'lines': list_concat(b.way.lines, g.lines, CASE WHEN o.edit = 'D' THEN []::VARCHAR[] ELSE [concat(coalesce(o.role, r.role), ':', r.text)] END)}) AS way
    FROM best b JOIN told r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.rn = b.rn + 1 JOIN gap g ON g.f = b.state
      JOIN options o ON o.f = g.t AND (o.of IS NULL OR o.of = r.role[1]) AND (o.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
    GROUP BY b.conv_id, r.rn, o.t
  )
), ended AS (
  SELECT f.conv_id, min({'cost': CAST(b.way.cost + g.cost AS BIGINT), 'audit': concat(b.way.audit, g.audit), 'lines': list_concat(b.way.lines, g.lines)}) AS way
  FROM facts f JOIN best b ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.rn = f.n JOIN gap g ON g.f = b.state AND g.t IN (0, 3) GROUP BY f.conv_id
)
SELECT o.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal,
  coalesce(e.way.cost, 0) AS cost, coalesce(e.way.audit, '') AS audit, sha256(coalesce(array_to_string(e.way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
ORACLE_SQL["op13_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tfs AS (SELECT doc_id, row, term, count(*) AS tf FROM words GROUP BY ALL),
docs AS (SELECT row, sum(tf) AS n FROM tfs GROUP BY row),
stats AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs WHERE term IN (SELECT term FROM asked) GROUP BY term), stats
), scored AS (
  SELECT a.item_id, t.row, t.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + CAST(50 * n * n_docs AS BIGINT) // all_terms)))) AS BIGINT) AS score
  FROM asked a JOIN weights USING (term) JOIN tfs t USING (term) JOIN docs USING (row), stats GROUP BY a.item_id, t.row, t.doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
