import re

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from scriptorium.llm import word_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def greedy(word, begins, continues):
    n, at = 0, 0
    while at < len(word):
        known = begins if at == 0 else continues
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return word_pieces._UNKNOWN
        at, n = end, n + 1
    return n


def test_documents(spark):
    begins, continues = map(set, word_pieces.vocabulary(PATH))
    texts = ["The quick brown fox's naïveté, isn't\tit?", None, "", " \n ", "日本語 テキスト ☃☃ \U0001f600x", "internationalisation" * 40, "a\x1cb\x85c d", "same", "same"]
    df = spark.createDataFrame([(i if i < 8 else None, t, 3) for i, t in enumerate(texts)], "doc_id bigint, text string, n_words int")
    got = {(r.doc_id): (r.n_words, r.n_tokens, r.n_unknown) for r in word_pieces.counts(df, PATH).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = [greedy(w, begins, continues) for w in words]
        assert got[i if i < 8 else None] == (len(words), sum(f & 0xFFFFFFFF for f in found), sum(f >> 40 for f in found))
    assert word_pieces.counts(df.limit(0), PATH).count() == 0


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=5)), st.lists(st.text("abc", min_size=1, max_size=5)), st.lists(st.text("abcd", min_size=1, max_size=12), min_size=1))
def test_equals_greedy(begins, continues, words):
    a = word_pieces.Automaton(begins, continues)
    for w in words:
        assert a.count(w) == greedy(w, set(begins), set(continues))
