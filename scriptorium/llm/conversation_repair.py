"""Repair of conversations by the cheapest edits, so that roles are those of an optional system turn and pairs of user and assistant.

Rows are ordered by conversation and turn over range partitions, so that a long conversation lies in many. Each run of at most
BLOCK rows becomes a word of one letter a row. DuckDB finds the cheapest edits of all words of a batch by one recursive query: a
recursion advances each word by a row and keeps, for each state of the grammar at its start and now, the least cost and the first
audit of that cost. Blocks of one conversation are put together by the same recursion over blocks, first within a partition, then
over partitions. Two audits of one cost over the same rows never begin one another (each further insert costs), so that the first
audit of the whole is made of first audits of its blocks.

Letters of an audit: K keep, R rerole to user or assistant (2), D delete (3; the only edit of blank and repeated rows), I insert a
turn of user or assistant without text (2). A truncated row that stays costs 1.

Defined results: null roles and texts are one space; rows go by turn, null first, then by role and text, so that equal rows may
change places; a row is repeated if an earlier one has its role and text (told by SHA-256); a role without a first letter s, u or a,
such as an empty one, fits nowhere as it is; a null conv_id is a conversation like others; further columns are ignored; an empty
table gives none. No task holds the texts of a conversation; its repaired turns are read in order in one task, a batch at a time, since
SHA-256 cannot be computed in parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Rows of a block, as a power of two.
BLOCK_BITS = 8
#: Bits of the number of a row within its partition, as monotonically_increasing_id() has them.
PART_BITS = 33
ROLES = {"u": "user", "a": "assistant"}
#: State after a turn by its role's first letter: 0 at the start, then 1 system, 2 user, 3 assistant.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: Inserts that lead from a state to a good end.
CLOSING = [0, 2, 1, 0]
WAYS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
WAYS_SQL = "array<struct<a: int, b: int, cost: bigint, audit: string>>"
#: Bytes of repaired turns that go on at once.
OUT_BYTES = 4 << 20


def _offered(state: int) -> list[tuple[int, str]]:
    """Roles that may follow state and that an edit can give, as state and letter."""
    return [(NEXT[state][x], x) for x in ROLES if x in NEXT[state]]


def moves() -> list[tuple[str, int, int, int, str]]:
    """(letter of a row, state before, state after, cost, audit) of the best way to take one row, inserts before it included.

    Letters: d for a row that must go, else the role's first letter or x, as a capital if the row is truncated.
    """
    best: dict[tuple[str, int, int], tuple[int, str]] = {}
    for letter in "dsuaxSUAX":
        for before in range(4):
            reached = [(before, 0)]
            for state, k in reached:
                options = [(state, DELETE, "D")]
                if letter != "d":
                    more = TRUNCATED * letter.isupper()
                    options += [(s, REROLE + more, "R") for s, _ in _offered(state)]
                    options += [(NEXT[state][letter.lower()], more, "K")] if letter.lower() in NEXT[state] else []
                for after, cost, edit in options:
                    found = (INSERT * k + cost, "I" * k + edit)
                    best[letter, before, after] = min(best.get((letter, before, after), found), found)
                reached += [(s, k + 1) for s, _ in _offered(state) if k < 2 and s not in {x for x, _ in reached}]
    return [(*k, *v) for k, v in sorted(best.items())]


_WORDS = """
WITH RECURSIVE best(k, entry, state, i, cost, audit) USING KEY (k, entry, state) AS (
  SELECT k, e, e, 0, 0::BIGINT, '' FROM words, (VALUES (0), (1), (2), (3)) t(e)
  UNION
  SELECT k, entry, state, i + 1, least.cost, least.audit FROM (
    SELECT b.k, b.entry, m.after AS state, b.i, min({'cost': b.cost + m.cost, 'audit': b.audit || m.audit}) AS least
    FROM best b JOIN words w ON w.k = b.k JOIN moves m ON m.before = b.state AND m.letter = substr(w.word, b.i + 1, 1)
    GROUP BY b.k, b.entry, m.after, b.i
  )
)
SELECT list({'a': entry, 'b': state, 'cost': cost, 'audit': audit} ORDER BY entry, state) AS ways FROM best GROUP BY k ORDER BY k
"""
_BLOCKS = """
WITH RECURSIVE best(k, entry, state, j, cost, audit) USING KEY (k, entry, state) AS (
  SELECT k, a, b, j, cost, audit FROM ways WHERE j = 1
  UNION
  SELECT k, entry, state, j + 1, least.cost, least.audit FROM (
    SELECT b.k, b.entry, w.b AS state, b.j, min({'cost': b.cost + w.cost, 'audit': b.audit || w.audit}) AS least
    FROM best b JOIN ways w ON w.k = b.k AND w.j = b.j + 1 AND w.a = b.state
    GROUP BY b.k, b.entry, w.b, b.j
  )
)
SELECT list({'a': entry, 'b': state, 'cost': cost, 'audit': audit} ORDER BY entry, state) AS ways FROM best GROUP BY k ORDER BY k
"""


def _duck():
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})


def _ways_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word of each row replaced by the best ways through it."""
    con = _duck()
    con.execute("CREATE TABLE moves (letter VARCHAR, before INTEGER, after INTEGER, cost BIGINT, audit VARCHAR)")
    con.executemany("INSERT INTO moves VALUES (?, ?, ?, ?, ?)", moves())
    for batch in batches:
        if batch.num_rows:
            con.register("words", pa.table({"k": pa.array(range(batch.num_rows), pa.int64()), "word": batch.column("word")}))
            yield _with_ways(batch, "word", con.sql(_WORDS).to_arrow_table())


def _ways_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """parts (the ways through blocks that follow each other) of each row replaced by the best ways through all."""
    con = _duck()
    for batch in batches:
        if batch.num_rows:
            con.register("lists", pa.table({"k": pa.array(range(batch.num_rows), pa.int64()), "parts": batch.column("parts")}))
            con.execute("CREATE OR REPLACE TABLE blocks AS SELECT k, unnest(range(1, len(parts) + 1)) AS j, unnest(parts) AS p FROM lists")
            con.execute("CREATE OR REPLACE TABLE ways AS SELECT k, j, w.a, w.b, w.cost, w.audit FROM (SELECT k, j, unnest(p) AS w FROM blocks)")
            yield _with_ways(batch, "parts", con.sql(_BLOCKS).to_arrow_table())


def _with_ways(batch: pa.RecordBatch, column: str, found: pa.Table) -> pa.RecordBatch:
    ways = found.column("ways").combine_chunks().cast(WAYS)
    ways = ways if isinstance(ways, pa.Array) else pa.concat_arrays(ways.chunks)
    return batch.set_column(batch.schema.get_field_index(column), "ways", ways)


def ordered(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) with key (conv_id as text, never null), mid (a number that rises in each conversation's order),
    trimmed facts of the row (initial, blank, truncated) and digest of role and text; written to the shared folder."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = rows.select(key.alias("key"), "conv_id", F.col("turn").cast("bigint").alias("turn"), role, text)
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # equal rows of one conversation may be many: a number tells them apart, so that they can lie in several partitions
    rows = rows.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(common.partitions(rows.sparkSession), *order, F.col("_n"))
    rows = rows.sortWithinPartitions(*order).drop("_n").withColumn("mid", F.monotonically_increasing_id())
    end = F.expr(r"TRIM(TRAILING ' \t\n\u000b\u000c\r' FROM text)")
    initial = F.substring("role", 1, 1)
    rows = rows.withColumns({
        "initial": F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x")),
        "blank": end == "",
        "truncated": ~F.right(end, F.lit(1)).isin(".", "!", "?"),
        "digest": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)),
    })
    return common.cut(rows, "turns")


def _broken(pairs: Column) -> Column:
    """How many of an array of two-letter strings are no su, ua or au."""
    return F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("bigint")


def _blocks(rows: DataFrame) -> DataFrame:
    """A row for each run of rows: key, block, counts of faults, first and last initial, and its word."""
    first = rows.groupBy("key", "digest").agg(F.min("mid").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.select("key", "mid", "initial", "blank", "truncated", "digest").join(first, ["key", "digest"], "left")
    again = ~F.col("blank") & F.coalesce(F.col("mid") > F.col("first"), F.lit(False))
    cut = F.col("truncated") & ~F.col("blank") & ~again
    letter = F.when(F.col("blank") | again, F.lit("d")).when(cut, F.upper("initial")).otherwise(F.col("initial"))
    rows = rows.select("key", "mid", F.shiftright("mid", BLOCK_BITS).alias("block"), F.col("blank").cast("bigint").alias("blank"), again.cast("bigint").alias("duplicate"), cut.cast("bigint").alias("truncated"), "initial", letter.alias("letter"))
    in_order = F.sort_array(F.collect_list(F.struct("mid", "letter", "initial")))
    found = rows.groupBy("key", "block").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), in_order.alias("row"))
    initials = F.array_join(F.col("row.initial"), "")
    pairs = F.transform(F.sequence(F.lit(1), F.length("initials") - 1), lambda i: F.substring(F.col("initials"), i, F.lit(2)))
    return (
        found.select("key", "block", "blank", "duplicate", "truncated", F.array_join(F.col("row.letter"), "").alias("word"), initials.alias("initials"))
        .withColumn("illegal", F.when(F.length("initials") > 1, _broken(pairs)).otherwise(F.lit(0).cast("bigint")))
        .withColumns({"opens": F.substring("initials", 1, 1), "ends": F.right("initials", F.lit(1))}).drop("initials")
    )


_FACTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, opens string, ends string"


def _put_together(found: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """Blocks that follow each other within keys as one."""
    columns = [order, "blank", "duplicate", "truncated", "illegal", "opens", "ends", "ways"]
    in_order = F.sort_array(F.collect_list(F.struct(*columns)))
    found = found.groupBy(*keys).agg(in_order.alias("of"))
    names = [c for c in found.columns if c != "of"]
    total = lambda c: F.aggregate(F.col(f"of.{c}"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    seams = F.when(F.size("of") > 1, _broken(F.zip_with(F.expr("slice(of.ends, 1, size(of) - 1)"), F.expr("slice(of.opens, 2, size(of) - 1)"), lambda a, b: F.concat(a, b)))).otherwise(F.lit(0).cast("bigint"))
    one = found.where(F.size("of") == 1).select(*names, *(F.element_at(f"of.{c}", 1).alias(c) for c in columns[1:]))
    many = found.where(F.size("of") > 1).select(
        *names, *(total(c).alias(c) for c in ("blank", "duplicate", "truncated")), (total("illegal") + seams).alias("illegal"),
        F.element_at("of.opens", 1).alias("opens"), F.element_at("of.ends", -1).alias("ends"), F.col("of.ways").alias("parts"),
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name != "of")
    return one.unionByName(many.mapInArrow(_ways_of_blocks, f"{kinds}, {_FACTS}, ways {WAYS_SQL}"))


def report(rows: DataFrame) -> DataFrame:
    """Of ordered() rows, for each conversation: key, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    blocks = _blocks(rows).mapInArrow(_ways_of_words, f"key string, block bigint, blank bigint, duplicate bigint, truncated bigint, ways {WAYS_SQL}, illegal bigint, opens string, ends string")
    within = _put_together(blocks, [F.col("key"), F.shiftright("block", PART_BITS - BLOCK_BITS).alias("part")], "block")
    found = _put_together(within, [F.col("key")], "part")
    closed = F.transform(
        F.filter("ways", lambda w: w["a"] == 0),
        lambda w: F.struct((w["cost"] + INSERT * F.element_at(F.array(*map(F.lit, CLOSING)), w["b"] + 1)).alias("cost"), F.concat(w["audit"], F.repeat(F.lit("I"), F.element_at(F.array(*map(F.lit, CLOSING)), w["b"] + 1))).alias("audit")),
    )
    found = found.withColumn("best", F.array_min(closed)).select("key", "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"))
    turns = rows.groupBy("key", "turn").agg(F.lit(1).alias("_")).groupBy("key")
    gaps = turns.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    return found.join(gaps, "key")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns: key, at (from 1), turn (null if inserted), role, text, edit. A partition holds whole conversations in their order.

    rows: those of ordered(); audits: report(). A conversation's audit comes before its rows, which are read one batch after the other.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, audit, place, state, at, size = None, "", 0, 0, 0, 0

        def insert() -> None:
            nonlocal place, state, at
            while place < len(audit) and audit[place] == "I":
                place, at = place + 1, at + 1
                state, initial = _offered(state)[0]
                out.append((key, at, None, ROLES[initial], "", "I"))

        def flush() -> pa.RecordBatch:
            nonlocal size
            size = 0
            columns = list(zip(*out)) if out else [[]] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))], names=["key", "at", "turn", "role", "text", "edit"])

        for batch in common.slices(batches, "text", OUT_BYTES):
            for k, mid, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "mid", "turn", "role", "text"))):
                if mid < 0:
                    insert()
                    key, audit, place, state, at = k, text, 0, 0, 0
                    continue
                insert()
                edit, place = audit[place], place + 1
                if edit == "D":
                    continue
                if edit == "R":
                    state, initial = _offered(state)[0]
                    role = ROLES[initial]
                else:
                    state = NEXT[state][role[:1]]
                at, size = at + 1, size + len(text)
                out.append((key, at, turn, role, text, edit))
            if size > OUT_BYTES or len(out) > 10_000:
                yield flush()
        insert()
        yield flush()

    heads = audits.select("key", F.lit(-1).cast("bigint").alias("mid"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    both = rows.select("key", "mid", "turn", "role", "text").unionByName(heads)
    both = both.repartition(common.partitions(rows.sparkSession), "key").sortWithinPartitions("key", "mid")
    return both.mapInArrow(walk, "key string, at bigint, turn bigint, role string, text string, edit string")


def digests(turns: DataFrame) -> DataFrame:
    """key and SHA-256 of `role:text`, joined by newlines, of conversations as repaired() deals them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for k, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "text"))):
                if k != key:
                    if sha:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield _digested(done)
        if sha:
            yield _digested([(key, sha.hexdigest())])

    def _digested(done: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in (0, 1)], names=["key", "repaired_sha256"])

    return turns.select("key", "role", "text").mapInArrow(run, "key string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) with faults by crc32 of `conv_id:turn`, mod 20: 0 drops a row, 1 empties its text, 2 takes its
    sentence ends away, 3 repeats it, 4 sets its role to user. Nulls of role and text are one space, also those of the ids in the sum."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text, role = F.coalesce(F.col("text").cast("string"), space), F.coalesce(F.col("role").cast("string"), space)
    rows = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), kind.alias("_kind"))
    times = F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("_kind <> 0").select("conv_id", "turn", "role", "text", F.explode(times).alias("_time")).drop("_time")


def audited(originals: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of originals: what is wrong with its rows, the cheapest repair and the digest of what it gives."""
    spark = rows.sparkSession
    zero = F.lit(0).cast("bigint")
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    with common.scratch(spark):
        rows = ordered(rows)
        found = common.cut(report(rows), "audits")
        hashes = digests(repaired(rows, found))
        ids = originals.select(key.alias("key"), "conv_id").distinct()
        out = ids.join(found, "key", "left").join(hashes, "key", "left").select(
            "conv_id", *(F.coalesce(F.col(c), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
            F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
        return common.cut(out, "repairs", keep=True)
