import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scriptorium.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["It's  a test.\n\nTwo\tlines ", None, "", "x<|endoftext|> y  <|endoftext|>", "long " * 3000, "naïve ÅÉ 日本語　text end\x1c\x1d x", "\x1f a \x85b", "It's  a test.\n\nTwo\tlines "]


def brute(rows):
    t, out, start = Tokenizer.from_file(PATH), {}, 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_equals_library(spark, tmp_path):
    rows = [(i * 7 % 11 if i else None, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(t, i, "clash") for i, t in rows], "text string, doc_id bigint, part string")
    token_files.write(df, str(tmp_path / "t"), PATH)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.index(spark, str(tmp_path / "t")).collect()}
    assert got == brute(rows)


def test_empty_table_and_selective_read(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    token_files.write(df, str(tmp_path / "e"), PATH)
    assert token_files.index(spark, str(tmp_path / "e")).count() == 0
    df = spark.range(50).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    token_files.write(df, str(tmp_path / "s"), PATH)
    part = token_files.read(spark, str(tmp_path / "s"), ["doc_id", "n_tokens"], 10, 12)
    assert sorted(r.doc_id for r in part.collect()) == [10, 11, 12]
    plan = part._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "ids" not in plan.split("ReadSchema")[1]


def test_repeated_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "same"), (1, "same"), (2, "other")], "doc_id bigint, text string")
    token_files.write(df, str(tmp_path / "r"), PATH)
    got = sorted((r.doc_id, r.start) for r in token_files.index(spark, str(tmp_path / "r")).collect())
    assert [g[0] for g in got] == [1, 1, 2] and got[0][1] == 0 and got[1][1] > 0 and got[2][1] == 2 * got[1][1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t　\x1c\x85ab'sté1!") + ["l", "\u2003", "\u2028"]), max_size=40))
def test_chunks_equal_library(text):
    coder = token_files.encoder(PATH)
    assert list(np.frombuffer(coder.encode([text])[0], "<u4")) == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_any_code_points_equal_the_library():
    rng = random.Random(8)
    coder, library = token_files.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    apart = [0x3E0B6, 0x638A, 0x3F7DA, 0x986C, 0x32E5A, 0x965E, 0x1DFDA, 0x98F8, 0x558, 0x10940, 0x1F600]
    texts = [chr(a) + chr(b) for a in apart for b in apart]
    for _ in range(4000):
        kinds = [lambda: rng.randrange(0x110000), lambda: rng.randrange(0x3000), lambda: rng.randrange(32, 127), lambda: rng.choice(apart), lambda: rng.choice([9, 10, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x3000])]
        points = (rng.choice(kinds)() for _ in range(rng.randrange(1, 40)))
        texts.append("".join(chr(c) for c in points if not 0xD800 <= c < 0xE000))
    texts.append("x" * 100_000 + "é" * 100_000)
    for text, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text[:60])
