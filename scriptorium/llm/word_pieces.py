"""Token counts of greedy word pieces by a linear longest-match automaton.

A word is cut into the longest vocabulary piece that begins it, then the longest that continues it, and so on; a
word that cannot be cut so is one unknown token. The automaton is a trie of the vocabulary with failure links: a
node that cannot go on with the next character has a fixed number of pieces that the greedy cut pops from what was
read, and a node for what then remains. Counting follows these links, one step for each character and no piece is
ever built; both tables are computed once, breadth first.

Defined results: words are runs without ASCII white space; a null or empty text has no words and no tokens; null
doc_ids and repeated rows are rows like any others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Words whose counts a Python worker keeps, and how long they may be; beyond the number the store starts anew.
KEPT, KEPT_LENGTH = 400_000, 48
SLICE_BYTES = 4 << 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UNKNOWN = 1 + (1 << 40)


def vocabulary(path: str, mark: str = "▁") -> tuple[list[str], list[str]]:
    """Pieces that begin words and pieces that continue them, of a sentencepiece file whose word beginnings carry mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [p[len(mark) :] for p in pieces if p.startswith(mark) and p.count(mark) == 1 and p != mark], [p for p in pieces if mark not in p]


class Automaton(dict):
    """Maps a word to its number of pieces; unknown words also add 1 << 40, so that sums carry both counts."""

    def __init__(self, begins: Iterable[str], continues: Iterable[str]):
        super().__init__()
        self.child: list[dict[str, int]] = [{}, {}]  # node 0 begins a word, node 1 continues it
        piece = [False, False]
        for root, pieces in ((0, begins), (1, continues)):
            for p in pieces:
                node = root
                for c in p:
                    if c not in self.child[node]:
                        self.child[node][c] = len(self.child)
                        self.child.append({})
                        piece.append(False)
                    node = self.child[node][c]
                piece[node] = bool(p) or piece[node]
        self.link: list[int] = [-1] * len(self.child)  # -1: the word is unknown
        self.popped = [0] * len(self.child)
        level = [0, 1]
        while level:
            below = []
            for node in level:
                for c, to in self.child[node].items():
                    below.append(to)
                    if piece[to]:
                        self.link[to], self.popped[to] = 1, 1
                        continue
                    at, n = self.link[node], self.popped[node]
                    while at >= 0 and c not in self.child[at]:
                        n += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[to], self.popped[to] = self.child[at][c], n
            level = below

    def __missing__(self, word: str) -> int:
        n = self.count(word)
        if len(word) <= KEPT_LENGTH:
            self[word] = n
        return n

    def count(self, word: str) -> int:
        child, link, popped = self.child, self.link, self.popped
        node = n = 0
        for c in word:
            while (to := child[node].get(c)) is None:
                n += popped[node]
                node = link[node]
                if node < 0:
                    return _UNKNOWN
            node = to
        while node != 1:
            n += popped[node]
            node = link[node]
            if node < 0:
                return _UNKNOWN
        return n


_automata: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """One for each worker process."""
    if path not in _automata:
        _automata.clear()
        _automata[path] = Automaton(*vocabulary(path))
    return _automata[path]


def counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = automaton(path)
        for batch in common.slices(batches, "text", SLICE_BYTES):
            if len(lengths) > KEPT:
                lengths.clear()
            words = [_WORD.findall(t) for t in common.texts(batch.column("text"))]
            sums = [sum(map(lengths.__getitem__, w)) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), pa.array([s & ((1 << 40) - 1) for s in sums], pa.int64()), pa.array([s >> 40 for s in sums], pa.int64())], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
