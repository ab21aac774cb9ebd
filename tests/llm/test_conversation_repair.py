import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from scriptorium.llm import conversation_repair as repair
from scriptorium.llm import queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")
LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(turns):
    seen, found = set(), []
    for role, text in turns:
        last = LAST.search(text)
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(turns, found):
    """The least (cost, audit) and its turns, by trying all edits, with at most two inserts before each row and at the end."""
    best = {"": (0, "", ())}  # by the initials so far, shortened to what the grammar needs of them
    state = lambda x: ("" if not x else x if x == "s" else "u" if x[-1] == "u" else "a") if GRAMMAR.fullmatch(x) or GRAMMAR.fullmatch(x + "a") or x == "s" else None

    def add(to, initials, way):
        s = state(initials)
        if s is not None and (s not in to or way[:2] < to[s][:2]):
            to[s] = way

    def inserted(ways):
        for _ in range(2):
            more = dict(ways)
            for s, (cost, audit, kept) in ways.items():
                for role in ("user", "assistant"):
                    add(more, {"": "", "s": "s", "u": "u", "a": "ua"}[s] + role[0], (cost + 2, audit + "I", (*kept, f"{role}:")))
            ways = more
        return ways

    for (role, text), fault in zip(turns, found):
        following = {}
        for s, (cost, audit, kept) in inserted(best).items():
            before = {"": "", "s": "s", "u": "u", "a": "ua"}[s]
            add(following, before, (cost + 3, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            cut = fault == "truncated"
            if role:
                add(following, before + role[0], (cost + cut, audit + "K", (*kept, f"{role}:{text}")))
            for other in ("user", "assistant"):
                add(following, before + other[0], (cost + 2 + cut, audit + "R", (*kept, f"{other}:{text}")))
        best = following
    return min(way for s, way in inserted(best).items() if s in ("", "a"))


def brute(originals, rows):
    out = {}
    for conv in {r[0] for r in originals}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [(r[2], r[3]) for r in own]
        found = faults(turns)
        initials = [r[:1] for r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") or not (a and b) for a, b in itertools.pairwise(initials))
        numbers = {r[1] for r in own} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit, kept = cheapest(turns, found)
        out[conv] = (gaps, *(found.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def got(df):
    rows = [(r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_whole_table(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    assert got(queries.op12_conversation_repair(spark, SF)) == brute(rows, damage(rows))


def scenes(n, seed=5):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown", "User"]
    texts = ["Yes.", "No", "Well!  ", "", None, " \t\n", "a\x1c", "why?\x85", "Ja.\x0b"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, 3, 10**9]), rng.choice(roles[: rng.choice([2, 3, 10])]), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randint(0, 99)}."))
    return rows


def test_random_conversations(spark):
    rows = scenes(300)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", key string, mid int")
    assert got(repair.audited(df, repair.damaged(df))) == brute(rows, damage(rows))


@pytest.mark.parametrize("bits", [0, 1, 8])
def test_conversations_of_many_blocks(spark, monkeypatch, bits):
    """Blocks of 1, 2 and 256 rows over several partitions give the same."""
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rng = random.Random(6)
    rows = scenes(30, seed=7) + [(99, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Same.", "same", f"t{t}.", f"t{t}"])) for t in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(repair.audited(df, repair.damaged(df))) == brute(rows, damage(rows))


def test_equal_rows_without_number(spark):
    rows = [(1, 5, "user", "Same.")] * 600 + [(2, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = got(repair.audited(df, df))
    assert plain[1][:6] == (0, 0, 599, 0, 599, 599 * 3 + 2) and plain[1][6] == "K" + "D" * 599 + "I" or plain[1][5] <= 1799
    assert plain == brute(rows, [(c, t, r or " ", x or " ") for c, t, r, x in rows])


def test_empty_table_and_turns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.audited(df, repair.damaged(df)).count() == 0
    df = spark.createDataFrame([(1, 1, "system", "Be good."), (1, 2, "assistant", "Hello."), (1, 4, "user", "Hm"), (1, 5, "user", "Bye.")], SCHEMA)
    rows = repair.ordered(df)
    turns = repair.repaired(rows, repair.report(rows)).orderBy("at").collect()
    best = cheapest([("system", "Be good."), ("assistant", "Hello."), ("user", "Hm"), ("user", "Bye.")], ["", "", "truncated", ""])
    assert [f"{t.role}:{t.text}" for t in turns] == list(best[2])
    assert [t.at for t in turns] == list(range(1, len(turns) + 1))
