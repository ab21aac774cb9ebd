import random
import re
from collections import defaultdict

import pytest

from scriptorium.llm import mixing


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / free for s in order}
        above = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        source = rng.choice(["b", "a", "c", None, "é", "\U0001f600", "Z", "tiny"] + ["hot"] * 5)
        if source == "tiny" and rng.random() < 0.9:
            source = "a"
        n = rng.choice([0, 1, 7, 7, 7, rng.randint(1, 300), rng.randint(1, 3000)])
        rows.append((i, None if n == 0 and i % 2 else " \t".join(["wörd"] * n), source, "x"))
    rows += rows[:5] + [(None, "a b c", "a", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target string")
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(got, key=str) == sorted(again, key=str) and len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = brute_targets(sizes)
    taken, target = defaultdict(int), {}
    for r in got:
        s = None if r.src == "~" else r.src[1:]
        taken[s] += r.taken
        target[s] = r.target
        assert r.source_size == sizes[s] and 0 <= r.taken <= 3 * r.size
    assert target == pytest.approx(want)
    for s in want:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 40), s


def test_apply_and_empty(spark):
    df = spark.createDataFrame([(i, "w " * (i % 9), "s%d" % (i % 4), "k") for i in range(200)], "doc_id bigint, text string, source string, copies string")
    out = mixing.apply(df)
    assert out.columns == df.columns
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: v for k, v in copies.items() if v}
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.withColumn("text", mixing.F.lit(None).cast("string"))).where("taken <> 0").count() == 0
