import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scriptorium.llm import lexical_search, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=50):
    docs = [(i, Counter(words(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, all_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, own in asked.items():
        found = []
        for i, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_whole_tables(spark):
    docs, items = (pq.read_table(f"{SF}/{x}.parquet").to_pylist() for x in ("documents", "benchmark"))
    expected = brute([(d["doc_id"], d["text"]) for d in docs], [(i["item_id"], i["text"]) for i in items])
    assert rows(queries.op13_lexical_search(spark, SF)) == expected


@pytest.mark.parametrize("shard_bytes, per_block", [(1, 1000), (400, 3), (32 << 20, 1000)])
def test_shards_blocks_ties_nulls_and_clashing_columns(spark, monkeypatch, shard_bytes, per_block):
    monkeypatch.setattr(lexical_search, "ITEMS", per_block)
    rng = random.Random(shard_bytes)
    texts = [None, "", " .-! ", "Alpha", "ALPHA beta", "naïve Straße ÄÖ İ", "a_b a^b a`b\x7fc 日本語 x\u3000y", "same text here", "same text here"]
    texts += [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "Zeta", "straße"]) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    docs = [(None if i == 5 else 7 if i in (9, 10) else i, t) for i, t in enumerate(texts)]
    items = [(i, t) for i, t in enumerate(["alpha beta", "Same TEXT", "", None, "nowhere", "straße ÄÖ 日本語", "a b c x", "zeta zeta eps gamma"])] + [(None, "delta"), (0, "gamma")]
    df = spark.createDataFrame([(t, i, 1, "s") for i, t in docs], "text string, doc_id bigint, score int, shard string").repartition(3)
    asked = spark.createDataFrame([(t, i, 1, "x") for i, t in items], "text string, item_id int, rank int, term string")
    found = lexical_search.search(lexical_search.index(df, shard_bytes), asked)
    assert rows(found) == brute(docs, items)
    few = lexical_search.search(lexical_search.index(df, shard_bytes), asked, 3)
    assert rows(few) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical_search.ranked(docs.limit(0), items).count() == 0
    assert lexical_search.ranked(docs, items.limit(0)).count() == 0
    assert lexical_search.ranked(docs.selectExpr("doc_id", "CAST(NULL AS string) AS text"), items).count() == 0


def test_very_long_document(spark):
    docs = [(1, "word " * 400_000 + "end"), (2, "end word"), (3, "x" * 1_000_000)]
    items = [(1, "end"), (2, "word " * 1000), (3, "x" * 1_000_000)]
    found = lexical_search.ranked(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows(found) == brute(docs, items)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**35 - 1)))
def test_packing(values):
    data, begins = lexical_search.packed(np.array(values, np.int64))
    assert lexical_search.unpacked(data.tobytes()).tolist() == values
    assert len(begins) == len(values) + 1 and begins[-1] == len(data)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 40), st.integers(0, 9), min_size=1), max_size=8), st.integers(1, 6))
def test_merge_equals_all_scores(lists, k):
    total = Counter()
    for x in lists:
        total.update(x)
    expected = sorted(((s, d) for d, s in total.items() if s > 0), key=lambda x: (-x[0], x[1]))[:k]
    given_ = [(max(x.values()), sorted(x), [x[d] for d in sorted(x)]) for x in lists]
    assert lexical_search.merge(given_, k) == expected
