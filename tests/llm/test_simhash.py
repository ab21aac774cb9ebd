import random
import re

import numpy as np
import xxhash

from scriptorium.llm import components, simhash


def brute_fp(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(rows):
    fps = [brute_fp(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return sorted((rows[i][0], fps[i], min(rows[k][0] for k in range(len(rows)) if label[k] == label[i])) for i in range(len(rows)))


def test_against_brute_force(spark):
    rng = random.Random(1)
    vocab = [f"W{i}é" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One"), (5, "ONE two"), (6, "É x"), (7, "é x")]
    base = [rng.choice(vocab) for _ in range(1500)]
    for i in range(8, 120):
        if i % 3 == 0:
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i * 5, " ".join(w)))
        else:
            rows.append((i * 5, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60)))))
    rows += rows[8:12]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, fp int")
    got = sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.classes(df).collect())
    assert got == brute_classes(rows)
    assert len({g[2] for g in got}) < len(got)
    kept = sorted(r.doc_id for r in simhash.keep_first(df).collect())
    assert kept == sorted({g[2] for g in got}) and simhash.keep_first(df).columns == df.columns
    assert simhash.classes(df.limit(0)).count() == 0
    nobody = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, "a b"), (None, "other words entirely")], "doc_id bigint, text string")
    assert sorted(str((r.doc_id, r.component_id)) for r in simhash.classes(nobody).collect()) == ["(7, 7)", "(None, 7)", "(None, 7)", "(None, None)"]
    assert simhash.keep_first(nobody).count() == 4


def test_tiles_find_every_link(spark):
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    near = fps[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    chain = [np.uint64(0)]
    for i in range(40):
        chain.append(chain[-1] ^ (np.uint64(3) << np.uint64(i)))
    every = np.unique(np.concatenate([fps, near, np.array(chain, np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in every.view(np.int64)], "fp bigint")
    got = {r.node: r.root for r in components.labels(simhash.links(df, 2, 16)).collect()}
    parent = {int(x): int(x) for x in every.view(np.int64)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    d = np.bitwise_count(every[:, None] ^ every[None, :])
    for i, j in zip(*np.nonzero((d <= 2) & (d > 0))):
        a, b = sorted((find(int(every[i].astype(np.int64))), find(int(every[j].astype(np.int64)))))
        parent[b] = a
    want = {k: find(k) for k in parent}
    assert {k: got.get(k, k) for k in want} == want
