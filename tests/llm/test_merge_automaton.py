import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scriptorium.llm import merge_automaton

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coder():
    return merge_automaton.Codec(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_whole_table_equals_the_library(spark, library):
    from scriptorium.llm import queries

    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11_merge_automaton(spark, SF).collect()}
    table = pq.read_table(f"{SF}/documents.parquet")
    assert got == {i: digests(library, t) for i, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist())}


def test_nulls_repeats_and_clashing_columns(spark, library):
    texts = [None, "", " ", "It's <|endoftext|> here<|endoftext|>", "same", "same", "a\x85b \u0378\u2fe0 x", "\x00\x7f\x80 naïve 日本", "word" * 50_000]
    df = spark.createDataFrame([(t, None if i < 2 else 7, "x", 1) for i, t in enumerate(texts)], "text string, doc_id int, ids string, n_tokens int")
    got = sorted((r.doc_id is None, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in merge_automaton.digests(df, PATH).collect())
    assert got == sorted((i < 2, *digests(library, t)) for i, t in enumerate(texts))
    assert merge_automaton.digests(df.limit(0), PATH).count() == 0


def test_any_code_points(coder, library):
    rng = random.Random(3)
    alphabets = ["ab", "aeinorst h", "éàüñ aei ", "日本語のテスト", "'stre '\n\t  ", "0123456789 .", "".join(map(chr, range(0x20, 0x3000)))]
    for _ in range(4000):
        alphabet = rng.choice(alphabets)
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        ids = np.frombuffer(b"".join(coder.encode(text)), "<u4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert coder.decode(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)


def test_very_long_words(coder, library):
    rng = random.Random(4)
    for text in ("a" * 300_000, "".join(rng.choice("abcdefgh") for _ in range(200_000)), "ab " * 500_000):
        assert np.frombuffer(b"".join(coder.encode(text)), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def merged(word, letters, merges):
    """BPE by its definition: each merge in turn, from left to right."""
    tokens = [letters[b] for b in word]
    for u, v, uv in merges:
        out = []
        for t in tokens:
            if out and out[-1] == u and t == v:
                out[-1] = uv
            else:
                out.append(t)
        tokens = out
    return tokens


@settings(max_examples=400, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(1, 12), st.lists(st.text("abc", min_size=1, max_size=14), min_size=1, max_size=8), st.sampled_from([3, 100]))
def test_equals_successive_merges(rng, n, words, limit):
    """Random merges over three letters, whatever they are, and a table that starts anew within words."""
    letters = list(range(256))
    tokens, merges, strings = [97, 98, 99], [], {bytes([b]) for b in range(256)}
    label = {b: bytes([b]) for b in range(256)}
    for k in range(n):
        u, v = rng.choice(tokens), rng.choice(tokens)
        if label[u] + label[v] in strings:
            continue
        label[256 + k] = label[u] + label[v]
        strings.add(label[256 + k])
        merges.append((u, v, 256 + k))
        tokens.append(256 + k)
    table = merge_automaton.Table(merge_automaton.Automaton(letters, merges), limit=limit)
    for w in words:
        found = table.encode(w.encode())
        assert found == merged(w.encode(), letters, merges)
        assert b"".join(table.automaton.label[t] for t in found) == w.encode()


def test_characters_in_parts():
    data = "aé日\U0001f600z".encode()
    for cut in range(len(data) + 1):
        whole, left = merge_automaton._characters(data[:cut])
        assert whole + left == data[:cut] and whole.decode() is not None
        again, rest = merge_automaton._characters(left + data[cut:])
        assert whole + again == data and rest == b""
    assert merge_automaton._characters(b"a\xffb") == ("a\ufffdb".encode(), b"")
