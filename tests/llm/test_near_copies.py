import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scriptorium.llm import common, near_copies


def brute_kept(rows):
    """The smallest id of each group of texts whose runs of five words have a Jaccard similarity of 0.8 or more."""
    sets = []
    for _, t in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if label[i] != label[j] and (not a and not b or a and b and len(a & b) >= 0.8 * len(a | b)):
                label = [label[j] if x == label[i] else x for x in label]
    return sorted(min(rows[k][0] for k in range(len(rows)) if label[k] == x) for x in set(label))


def test_near_copies_of_a_few_edited_words_go(spark):
    rng = random.Random(5)
    vocab = [f"w{i}é" for i in range(400)]
    rows = [(0, None), (1, " \t"), (2, "one two"), (3, "ONE  two"), (4, "one two three")]
    for g in range(40):
        base = [rng.choice(vocab) for _ in range(rng.choice([40, 150, 700]))]
        for c in range(rng.randint(1, 4)):
            w = list(base)
            for _ in range(c and rng.randint(1, max(1, len(w) // 45))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((100 + 10 * g + c, " ".join(w)))
    base = [rng.choice(vocab) for _ in range(300)]
    for i in range(80):  # more than a bucket's members are tried with
        w = list(base)
        for _ in range(4):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((1000 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_kept(rows)
    assert len(want) < len(rows) - 100
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == want


def test_stage_equals_brute_force_on_the_tables(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert kept == brute_kept(rows) and 145 not in kept and 177 not in kept


def test_long_texts_and_empty_tables(spark):
    assert len(near_copies.wide_fingerprint(near_copies.shingles("a b c " * 20_000))) == near_copies.BITS // 64
    assert near_copies.keep_first(spark.createDataFrame([], "doc_id bigint, text string, x int")).columns == ["doc_id", "text", "x"]


def test_rows_with_repeated_or_null_ids_are_decided_each(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a + " end"), (2, b), (2, b), (3, b + " end"), (None, a), (None, c), (None, c + " end")]
    kept = near_copies.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in kept) == [(0, "c"), (1, "a"), (2, "b")]


@pytest.mark.parametrize("tile,per", [(2048, 1 << 16), (16, 700)])
def test_groups_that_look_alike_are_decided_by_their_runs(spark, tile, per):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(500)]
    rows = [(0, ""), (1, " "), (2, "a b c d e f g h"), (3, "a b c d e f g h i")]
    for g in range(3):  # texts of one group share most of their runs, but few share four in five
        base = [rng.choice(vocab) for _ in range(160)]
        for i in range(45):
            at = rng.randrange(0, 100)
            w = base[:at] + [rng.choice(vocab) for _ in range(rng.choice([4, 14, 20, 26]))] + base[at + 18 :]
            rows.append((100 * (g + 1) + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = near_copies.signatures(df).select("node", "size", "w").dropDuplicates(["node"])
    texts = df.select(F.xxhash64("text").alias("node"), "text")
    named = {r.node: r.doc_id for r in df.select(F.xxhash64("text").alias("node"), "doc_id").collect()}
    root = {named[r.node]: named[r.root] for r in near_copies.near_roots(common.cut(signed), texts, tile, per).collect()}
    groups = {}
    for i, _ in rows:
        groups.setdefault(root.get(i, i), []).append(i)
    kept = sorted(min(g) for g in groups.values())
    assert kept == brute_kept(rows) and 20 < len(kept) < len(rows) - 20
