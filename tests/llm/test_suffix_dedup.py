import hashlib
import random

import numpy as np
import pytest

from scriptorium.llm import suffix_dedup as sd


def brute(rows):
    least = {}
    raw = [(i if i is not None else sd.common.NULL_ID, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            least[w] = min(i, least.get(w, i))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for p in range(len(b) - 49):
            if least[b[p : p + 50]] < i:
                gone[p : p + 50] = [True] * 50
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def rows(seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé日 ") for _ in range(rng.randint(2, 9))) for _ in range(40)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passages = [text(n) for n in (8, 9, 10, 12, 30, 200)] + ["x" * 70, "ab" * 60]
    out = [(None, passages[4] + text(5)), (3, None), (4, ""), (5, "y" * 49), (6, "y" * 50), (7, "y" * 51), (8, "y" * 400)]
    for i in range(10, 90):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            parts += [rng.choice(passages), text(rng.randint(0, 20))]
        out.append((rng.randint(0, 300) * 2 + 1, rng.choice(["", " "]).join(parts)))
    for _ in range(15):  # near copies: one byte off at some place
        i, t = rng.choice(out[7:])
        k = rng.randrange(len(t) + 1)
        out.append((1000 + rng.randint(0, 99), t[:k] + "Z" + t[k + 1 :]))
    return out + out[20:24] + [(2000 + k, out[30][1]) for k in range(12)]


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_against_brute_force(spark, seed, small, monkeypatch):
    data = rows(seed)
    df = spark.createDataFrame([(t, i, "x") for i, t in data], "text string, doc_id bigint, grp string").repartition(5)
    if small:  # documents are moved without a broadcast list
        monkeypatch.setattr(sd, "BROADCAST_DOCS", 0)
    got = sorted((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.removals(df).collect())
    assert got == brute(data)
    assert sum(g[2] for g in got) > 1000


def test_segments_and_covers():
    rng = np.random.default_rng(1)
    differences = {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER}
    assert differences == set(range(sd.PERIOD))
    data = rng.integers(97, 99, 3 * sd.SEGMENT + 777).astype(np.uint8)
    ends = np.array([10, 10, 59, 109, sd.SEGMENT - 3, sd.SEGMENT + 60, len(data)])
    at, hashes, low, high = sd.anchors(data, ends)
    assert ((low <= at) & (at <= low + sd.SPAN) & (at <= high + sd.SPAN) & (low <= high) & (high <= at)).all()
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high)])
    starts = np.concatenate([[0], ends[:-1]])
    want = np.concatenate([np.arange(s, e - 49) for s, e in zip(starts, ends) if e - s >= 50])
    assert sorted(windows) == sorted(want)
    h = np.sort(hashes)
    assert (sd._unplanes(sd._planes(h)) == h).all()


def test_contexts_settle_windows_exactly():
    rng = np.random.default_rng(5)
    base = rng.integers(97, 99, (6, sd.WIDTH)).astype(np.uint8)
    around = base[rng.integers(0, 6, 300)].copy()
    for r in around[::3]:
        r[rng.integers(0, sd.WIDTH)] ^= 1
    windows = np.sort(rng.integers(0, sd.SPAN + 1, (300, 2)), 1).astype(np.uint8)
    ids = rng.integers(0, 100, 300)
    got = sd.later_windows(around, windows, ids)
    for o in range(sd.SPAN + 1):
        for i in range(300):
            here = windows[i, 0] <= o <= windows[i, 1] and any(windows[j, 0] <= o <= windows[j, 1] and ids[j] < ids[i] and (around[j, o : o + 50] == around[i, o : o + 50]).all() for j in range(300))
            assert bool(got[i] >> o & 1) == here


def test_cleaned_keeps_columns(spark):
    passage = "shared words that go on for a good while, é and more " * 3
    df = spark.createDataFrame([(2, "b " + passage, 1), (1, passage + "a", 2), (3, None, 3), (2, "b " + passage, 1)], "doc_id bigint, text string, n_chars bigint")
    out = sd.cleaned(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id, r.text, r.n_chars) for r in out.collect() if r.text is not None)
    assert got == [(1, passage + "a", len(passage) + 1), (2, "b", 1), (2, "b", 1)]
    assert sd.removals(df.limit(0)).count() == 0
