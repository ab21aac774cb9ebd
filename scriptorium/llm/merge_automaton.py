"""Byte-level BPE by a tokenization automaton: encode words by table-driven transitions, decode by emitting arc labels.

Merges are compiled one after the other. The automaton's arcs are labelled with tokens; before the first merge it has one state
and an arc from it to itself for each byte. Merge (u, v) works on all places where u leads from p to q and v from q to r: q gets a
copy in which v is missing, arcs u lead to that copy from then on, and new arcs uv lead from p to r. What the automaton accepts
are then exactly the token sequences that the merges make, one for each byte string. Arcs of one label lead to one state at any
time, so that a state is its original less one label, and a merge adds one state: the whole takes memory in proportion to the merges.

For encoding, the token arcs are read byte by byte: a table state is the set of arcs under way, of which exactly one ends with each
byte. Table states are made when a text first asks for them and kept, up to a number beyond which the table starts anew.

Defined results: a null text is empty and has no ids; its digests are those of no bytes. Every row gives one row, whatever its doc_id
(null and repeated ones included); further columns of the input are ignored; an empty table gives none. Texts are whole at any length.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .token_files import _LATIN, _PATTERN, _byte_letters, settled

#: Bytes of text encoded at once; texts longer than this many characters are cut into words as they are read.
SLICE_BYTES, LONG = 2 << 20, 1 << 20
#: Table states and transitions, and ids of words, that a Python worker keeps; beyond these numbers each store starts anew.
TABLE, KEPT, KEPT_LENGTH = 120_000, 400_000, 48
#: Words whose ids are in memory at once.
WORDS = 1 << 16
NEVER, NODE = 1 << 62, 32
NODES = (1 << NODE) - 1
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Automaton:
    """The automaton over tokens. letters: token of each byte; merges: (left, right, merged) in their order."""

    def __init__(self, letters: list[int], merges: Iterable[tuple[int, int, int]]):
        self.letters = letters
        self.label: dict[int, bytes] = {t: bytes([b]) for b, t in enumerate(letters)}
        self.target = dict.fromkeys(letters, 0)
        self.parent, self._lost, self._at = [-1], [-1], [-1]
        self.made: dict[int, tuple[int, int]] = {}
        takers: dict[int, list[int]] = {}
        for rank, (u, v, uv) in enumerate(merges):
            self.label[uv] = self.label[u] + self.label[v]
            if u not in self.target or v not in self.target or self._gone(self.target[u], v, takers):
                continue  # no string brings u before v, so the merge makes nothing
            q = self.target[u]
            self.target[uv] = self.target[v]
            self.made[uv] = (u, rank)
            takers.setdefault(v, []).append(len(self.parent))
            self.target[u] = len(self.parent)
            self.parent.append(q)
            self._lost.append(v)
            self._at.append(rank)
        self._settle(takers)

    def _gone(self, state: int, token: int, takers: dict[int, list[int]]) -> bool:
        """While merges are compiled: whether state has no arc of token."""
        limit = NEVER
        while True:
            own = takers.get(token)
            if own:
                known, s = set(own), state
                while s > 0:
                    if s in known and self._at[s] <= limit:
                        return True
                    s = self.parent[s]
            if token not in self.made:
                return False
            token, limit = self.made[token]

    def _settle(self, takers: dict[int, list[int]]) -> None:
        """Number the states so that a state and all made from it are a range: a missing label is then found by one search."""
        n = len(self.parent)
        under = [1] * n
        for s in range(n - 1, 0, -1):
            under[self.parent[s]] += under[s]
        first, following = [0] * n, [1] * n
        for s in range(1, n):
            p = self.parent[s]
            first[s] = first[p] + following[p]
            following[p] += under[s]
        self._first = first
        self._missing: dict[int, tuple[list[int], list[int], list[int]]] = {}
        for token, states in takers.items():
            states = sorted(states, key=first.__getitem__)
            self._missing[token] = ([first[s] for s in states], [first[s] + under[s] for s in states], [self._at[s] for s in states])

    def has(self, state: int, token: int) -> bool:
        """Whether an arc of token leaves state: it does if, of token and what it was merged from at its left, none was missing when needed."""
        limit, place = NEVER, self._first[state]
        while True:
            missing = self._missing.get(token)
            if missing:
                k = bisect_right(missing[0], place) - 1
                if k >= 0 and place < missing[1][k] and missing[2][k] <= limit:
                    return False
            if token not in self.made:
                return True
            token, limit = self.made[token]


class Table:
    """The automaton read byte by byte. State 0 is the start of a word; last[s] is the token that ends where s is reached."""

    def __init__(self, automaton: Automaton, limit: int = TABLE):
        self.automaton, self.limit = automaton, limit
        self.size = {t: len(x) for t, x in automaton.label.items()}
        self._node: dict[int, int] = {}  # node * 256 + byte: next node, of the trie of all labels
        self._token = [-1]
        for t in [*automaton.letters, *automaton.made]:
            at = 0
            for b in automaton.label[t]:
                at = self._node.setdefault(at << 8 | b, len(self._token))
                if at == len(self._token):
                    self._token.append(-1)
            self._token[at] = t
        self._restart()

    def _restart(self) -> None:
        self.arcs: list[tuple[int, ...]] = [(0,)]  # arcs under way: state that they leave * 2**NODE + node of the trie
        self.last = [-1]
        self._known = {self.arcs[0]: 0}
        self.next: dict[int, int] = {}

    def _step(self, state: int, byte: int) -> int:
        """Add the transition of state by byte."""
        under_way, ended = [], -1
        child, token, has = self._node.get, self._token, self.automaton.has
        for arc in self.arcs[state]:
            node = child((arc & NODES) << 8 | byte)
            if node is None:
                continue
            under_way.append(arc & ~NODES | node)
            if ended < 0 <= token[node] and has(arc >> NODE, token[node]):
                ended = token[node]
        under_way.append(self.automaton.target[ended] << NODE)
        key = (*under_way, ~ended)
        found = self._known.setdefault(key, len(self.arcs))
        if found == len(self.arcs):
            self.arcs.append(tuple(under_way))
            self.last.append(ended)
        self.next[state << 8 | byte] = found
        return found

    def encode(self, word: bytes) -> list[int]:
        """The tokens of word."""
        if len(self.arcs) > self.limit or len(self.next) > 4 * self.limit:
            self._restart()
        state, ends, before = 0, [], 0  # ends: table states by place from before on, tokens up to it
        get = self.next.get
        for b in word:
            found = get(state << 8 | b)
            if found is None:
                if len(self.arcs) > 2 * self.limit:  # within one long word: go on from the arcs under way
                    ends[before:] = map(self.last.__getitem__, ends[before:])
                    before, arcs = len(ends), self.arcs[state]
                    self._restart()
                    get, state = self.next.get, 1
                    self.arcs.append(arcs)
                    self.last.append(-1)
                found = self._step(state, b)
            state = found
            ends.append(found)
        tokens, at, last, size = [], len(word), self.last, self.size
        while at:
            t = last[ends[at - 1]] if at > before else ends[at - 1]
            tokens.append(t)
            at -= size[t]
        tokens.reverse()
        return tokens


class Codec(dict):
    """Encodes and decodes as the tokenizers library does with a byte-level BPE file; keeps the ids of frequent words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, cut = file["model"], file["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or file["normalizer"] or odd:
            raise ValueError(f"{path} is no plain byte-level BPE file")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in file["added_tokens"]):
            raise ValueError(f"{path} has added tokens that depend on what stands beside them")
        vocab, letters = model["vocab"], _byte_letters()
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.automaton = Automaton([vocab[letters[b]] for b in range(256)], [(vocab[u], vocab[v], vocab[u + v]) for u, v in merges])
        self.table = Table(self.automaton)
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.labels = {**self.automaton.label, **{t: s.encode() for s, t in self.added.items()}}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self._library, self._bytes = Tokenizer.from_file(path).pre_tokenizer, {c: b for b, c in letters.items()}

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.table.encode(word.encode()), "<u4").tobytes()
        if len(word) <= KEPT_LENGTH:
            self[word] = ids
        return ids

    def _words(self, text: str) -> Iterable[str]:
        """The words into which the file's pre-tokenizer cuts text; characters that Unicode has not assigned are left to the library's tables."""
        pattern = _LATIN
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pattern = _PATTERN
                if not settled(text):
                    return (bytes(map(self._bytes.__getitem__, w)).decode() for w, _ in self._library.pre_tokenize_str(text))
        return (m.group() for m in pattern.finditer(text)) if len(text) > LONG else pattern.findall(text)

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of text as little-endian unsigned 32-bit integers, in parts."""
        for part in self._special.split(text) if self._special else [text]:
            if part in self.added:
                yield np.array([self.added[part]], "<u4").tobytes()
                continue
            words = iter(self._words(part))
            while block := list(islice(words, WORDS)):
                if len(self) > KEPT:
                    self.clear()
                yield b"".join(map(self.__getitem__, block))

    def decode(self, ids: np.ndarray) -> bytes:
        """What the ids stand for: the labels of their arcs one after the other."""
        return b"".join(map(self.labels.__getitem__, ids.tolist()))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One for each worker process."""
    if path not in _codecs:
        _codecs.clear()
        _codecs[path] = Codec(path)
    return _codecs[path]


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the text decoded from them, of every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for batch in common.slices(batches, "text", SLICE_BYTES):
            n, of_ids, of_text = [], [], []
            for text in common.texts(batch.column("text")):
                count, ids_hash, left = 0, hashlib.sha256(), b""
                text_hash = hashlib.sha256()
                for part in coder.encode(text):
                    ids_hash.update(part)
                    count += len(part) // 4
                    whole, left = _characters(left + coder.decode(np.frombuffer(part, "<u4")))
                    text_hash.update(whole)
                text_hash.update(left.decode("utf-8", "replace").encode())
                n.append(count)
                of_ids.append(ids_hash.hexdigest())
                of_text.append(text_hash.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, SCHEMA)


def _characters(data: bytes) -> tuple[bytes, bytes]:
    """UTF-8 of the whole characters of data, and the bytes of a character that is not complete at its end; wrong bytes become U+FFFD."""
    end = len(data)
    for back in range(1, min(4, end) + 1):
        lead = data[end - back]
        if lead >= 0xC0:
            if back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                end -= back
            break
        if lead < 0x80:
            break
    whole = data[:end]
    try:
        whole.decode()
        return whole, data[end:]
    except UnicodeDecodeError:
        return whole.decode("utf-8", "replace").encode(), data[end:]
