import hashlib
import random
import unicodedata

import pytest

from scriptorium.llm import fingerprints

TEXTS = ["Straße  und\tmehr", "STRASSE und mehr ", "ﬁne", "fine", None, "", "x", "é", "é", "日本語 テキスト", "\U0001f600" * 9, "a" * 20000]


WHITE = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def plain_form(text):
    """The canonical form, character by character: compatibility forms, folded, white space as single spaces."""
    nfkc = lambda t: unicodedata.normalize("NFC", unicodedata.normalize("NFKD", t))
    out = []
    for c in nfkc("".join(x.casefold() for x in nfkc(text))):
        if c not in WHITE:
            out.append(c)
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out).rstrip(" ").encode("utf-8", "surrogatepass")


def test_canonical_form():
    rng = random.Random(4)
    ranges = [(32, 127), (0xA0, 0x250), (0x300, 0x370), (0x1E00, 0x2100), (0x3000, 0x3100), (0xAC00, 0xAC80), (0xFB00, 0xFB10), (0xFF00, 0xFFF0), (0x1D400, 0x1D500)]
    for _ in range(3000):
        text = "".join(rng.choice(WHITE) if rng.random() < 0.2 else chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(30)))
        assert fingerprints.canonical(text) == plain_form(text), ascii(text)


def brute(rows):
    order = sorted([(i is not None, i or 0, t or "", i) for i, t in rows])
    out = []
    for k, (_, _, text, i) in enumerate(order):
        following = order[(k + 1) % len(order)][2]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        form = [plain_form(x) for x in (text, changed, following)]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), form[0], form[1], float(form[0] == form[1]), float(form[0] == form[2])))
    return out


def agrees(got, want):
    assert sorted(map(str, [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got])) == sorted(map(str, [(*w[:3], *w[5:]) for w in want]))
    prints, forms = {}, {}
    by = {(r.doc_id, r.edited_sha256): r for r in got}
    for w in want:
        r = by[w[0], w[2]]
        for f, form in ((r.fingerprint, w[3]), (r.edited_fingerprint, w[4])):
            assert prints.setdefault(form, f) == f and forms.setdefault(f, form) == form


def rows(n):
    rng = random.Random(n)
    return [(i * 13 % (7 * n), rng.choice(TEXTS)) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 300])
def test_against_brute_force(spark, n):
    data = rows(n)
    df = spark.createDataFrame([(t, i, 5) for i, t in data], "text string, doc_id bigint, role int").repartition(3)
    agrees(fingerprints.edited(df).collect(), brute(data))


def test_repeated_and_null_ids(spark):
    data = [(1, "a b"), (1, "a b"), (None, "first half"), (1, "zz zz"), (3, None)] + [(9, "ab")] * 9
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    agrees(fingerprints.edited(df).collect(), brute(data))


def test_colliding_digests_are_told_apart(spark):
    data = rows(60)
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    agrees(fingerprints.edited(df, lambda form: str(len(form) % 3)).collect(), brute(data))
