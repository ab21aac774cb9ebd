import random
import zlib

import numpy as np

from scriptorium.llm import toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    stems = ["grumblefex", "snarkwit", "hobgoff"]
    out = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 300))]
        bad = i % 3 == 0
        if bad:
            for _ in range(rng.randint(2, 4)):
                w = rng.choice(stems)
                words.insert(len(words) // 2, w + rng.choice(["", "x", "z!", "en", "er", w[-1] * rng.randint(1, 3)]))
        out.append((i, " ".join(words), int(bad)))
    return out


def test_held_out_accuracy_and_edge_cases(spark):
    rows = corpus(900, 1)
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows] + [(9001, None, "en", 0.1), (9002, "", "en", 0.1), (None, "plain", "x", 0.2), (5, rows[5][1], "en", 0.3)], "doc_id bigint, text string, lang string, score double")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if i % 10] + [(77, None), (9002, 0), (1, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = {i: b for i, _, b in rows}
    judged = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert len(judged) > 100 and np.mean([a == b for a, b in judged]) >= 0.95
    assert [r.predicted for r in got if r.doc_id in (9001, 9002)] == [0, 0]
    assert model.logits(["calm words " * 10_000 + "snarkwittt grumblefexxo hobgoffed"])[0] > model.logits(["calm words " * 10_000])[0] + 2
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r.predicted for r in got)
    again = toxicity.score(docs.repartition(5), toxicity.fit(docs.repartition(3), labels)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    for labels in ([], [(1, 0)]):
        found = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))).collect()
        assert len(found) == 2 and len({r.score for r in found}) == 1
    assert toxicity.score(docs.limit(0), toxicity.Model(np.zeros(1 << toxicity.BITS), 0)).count() == 0


def test_scores_do_not_depend_on_the_batch():
    model = toxicity.Model(np.random.default_rng(0).normal(size=1 << toxicity.BITS), -1)
    texts = ["", "one", "Two, three!", "ä ö ü " * 40, "x" * 500, " "]
    assert np.allclose(model.logits(texts), [model.logits([t])[0] for t in texts])


def plain_score(model, text):
    """The score of a text word by word, without arrays of all words."""
    words = [w for w in "".join(c if ord(c) >= 128 or c.isalnum() else " " for c in text.lower()).split(" ") if w]
    if not words:
        return 1 / (1 + np.exp(-model.bias))

    def value(word):
        raw, parts = f" {word} ".encode(), []
        for n in toxicity.GRAMS:
            for i in range(len(raw) - n + 1):
                h = 0
                for b in raw[i : i + n]:
                    h = (h * 16777619 & 0xFFFFFFFF) ^ b
                mixed = (h ^ h >> 15) * 2246822519 & 0xFFFFFFFF
                parts.append(float(model.table[mixed >> 32 - toxicity.BITS]))
        return parts

    half, best = toxicity.PASSAGE // 2, -np.inf
    means = [np.mean(value(w)) if value(w) else 0.0 for w in words]
    for i in range(0, len(words), half):
        best = max(best, sum(means[i : i + toxicity.PASSAGE]) / toxicity.PASSAGE + model.bias)
    return 1 / (1 + np.exp(-np.clip(best, -50, 50)))


def test_scores_equal_a_plain_computation():
    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.normal(0, 3, 1 << toxicity.BITS), -0.7)
    vocab = ["abc", "défi", "longerword", "x1", "zz", "mid", "überhaupt", "twelve"]
    texts = ["", " .,! ", "abc", *[" ".join(rng.choice(vocab, rng.integers(1, 90))) for _ in range(40)], "Abc, DÉFI! " * 30]
    assert np.allclose(model.scores(texts), [plain_score(model, t) for t in texts], atol=1e-6)


def test_rows_of_one_id_train_alike_in_any_order(spark):
    rows = [(i, ("bad words here " if i % 2 else "fine words there ") * 5 + str(i)) for i in range(40)] + [(3, "another text of the same id"), (3, "a third")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    tables = [toxicity.fit(spark.createDataFrame(r, "doc_id bigint, text string").repartition(n), labels).table for r, n in ((rows, 1), (rows[::-1], 3))]
    assert np.array_equal(*tables)
