import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from scriptorium.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(3)
    syllables = ["the", "ion", "er", "é", "ß", "ation", "日本", "\U0001f600", "x", "aa", " ", "  ", ", ", "\n", "'s"]
    out = [None, "", " ", "▁ mark", "a", "\n\n  indented\ttext \x00", "same", "same"]
    for n in (3, 40, 399, 400, 401, 1500, 5000):
        out.append("".join(rng.choice(syllables) for _ in range(n)))
        out.append("".join(rng.choice(syllables[:10]) for _ in range(n)))  # no spaces: no part of its own
    return [*out, "a" * 3000, " " * 1000, out[-1], out[-1], out[-4]]


@pytest.mark.parametrize("chunk,block", [(400, 2), (37, 3), (pieces.CHUNK, pieces.BLOCK)])
def test_equals_library(spark, chunk, block):
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate(texts())] + [(12, texts()[12], "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3)
    encoded = pieces.encode(df, PATH, chunk, block)
    got = sorted((str(r.doc_id), r.ids) for r in encoded.collect())
    assert got == sorted((str(i), SP.encode(t or "")) for i, t, _ in rows)
    back = {r.doc_id: r.text for r in pieces.decode(encoded, PATH).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t, _ in rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert pieces.decode(pieces.encode(df, PATH), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcenorst ▁é.,'\n0日"), max_size=60))
def test_paths_equal_library(text):
    assert np.frombuffer(pieces.model(PATH).encode(pieces.normal(text)), np.uint32).tolist() == SP.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**9))
def test_product_is_associative(seed):
    rng = np.random.default_rng(seed)
    a, b, c = (np.where(rng.random(s) < 0.4, pieces.YES, pieces.NO).astype(np.float32) for s in ((2, 3), (3, 4), (4, 2)))
    assert np.array_equal(pieces.product(pieces.product(a, b), c), pieces.product(a, pieces.product(b, c)))
