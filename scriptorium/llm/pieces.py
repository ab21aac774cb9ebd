"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text's pieces are a path through the lattice of its vocabulary matches. For a BPE file a sequence of pieces is
the encoding if and only if merging each two neighbours alone gives these two again, so steps between such
neighbours weigh 0 and all others minus infinity; the encoding is the one path of weight 0. The state at a position is
the last pieces that end shortly before or at it, so a chunk of text is a matrix of weights from the states
at its left boundary to those at its right one. Giant documents are split into chunks anywhere; each chunk's
matrix comes from one pass over its lattice; matrices are combined associatively (max-plus products, in blocks of
chunks, then over blocks); forward and backward weights together leave one state on the path at every boundary, and each
chunk is traced back alone between its two states. Chunks are dealt to tasks; a document's text is whole only where it is read and
cut, as one value of the input, and its ids where they are gathered into one value of the result.

Inside a chunk the lattice falls apart where no piece can span two characters (before a word mark that follows
another character); the path through each such part depends on nothing outside and is kept for frequent words.

The file's own conventions hold: spaces become word marks, one is put before the text, characters outside the
vocabulary become byte pieces. Defined results: a null or empty text has no pieces; a literal word mark in a text is
encoded as a space, and decoded so; null doc_ids and repeated rows are rows like any others; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MARK = "▁"
#: Characters of a chunk; longer documents are split.
CHUNK = 65_536
#: Chunks whose matrices one task multiplies.
BLOCK = 64
#: Paths of words, and weights of pairs, that a Python worker keeps of late; those of the time before are kept once more.
KEPT = 200_000
#: Words up to this length are kept.
KEPT_LENGTH = 48
SLICE_BYTES = 2 << 20
_LETTER = re.compile(r"[^\W\d_]")
NO, YES = np.float32(-np.inf), np.float32(0)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two matrices of weights."""
    return np.stack([(row[:, None] + b).max(0, initial=NO) for row in a]) if len(a) else np.zeros((0, b.shape[1]), np.float32)


class Model:
    """A sentencepiece file of BPE type: pieces with the order in which merges take place."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.plain: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.plain.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.plain.append(b"" if sp.is_control(i) else " ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.rank[piece] = -sp.get_score(i)
                self.plain.append(piece.replace(MARK, " ").encode())
        self.longest = max(map(len, self.ids))
        self.size = [len(p) for p in map(sp.id_to_piece, range(sp.get_piece_size()))]
        self.piece = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("the file has pieces with a word mark inside; words are no parts of their own")
        self.whole = {p: i for p, i in self.ids.items() if len(p) == 1 or self.merged(p) == [p]}
        ends: dict[str, set[int]] = {}
        for p in self.whole:
            if len(p) > 1:
                ends.setdefault(p[-2:], set()).add(len(p))
        #: Lengths of the pieces that end in two characters, longest first.
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ends.items()}
        self.trie: dict = {}  # by character; None leads to the id of the piece that ends here
        for p, i in self.whole.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[None] = i
        self.parts = self._parts()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}

    def _parts(self) -> re.Pattern:
        """Cuts a text in normal form where no piece spans: at word marks, at line ends, and before what no letter precedes in any piece."""
        followed = {b for p in self.ids for a, b in zip(p, p[1:]) if _LETTER.match(a)}
        free = "".join(re.escape(c) for c in map(chr, range(33, 127)) if not c.isalnum() and c != "_" and c not in followed)
        lines = "" if any("\n" in p for p in self.ids) else "\n"
        if not free + lines:
            return re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        line_runs = "|\n+" if lines else ""
        return re.compile(f"{MARK}*[^\\W\\d_]+(?=[{free}{lines}])|{MARK}*[^{MARK}{lines}]+|{MARK}+{line_runs}")

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging one pair after another."""
        parts = list(text)
        while True:
            ranks = [(self.rank[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.rank]
            if not ranks:
                return parts
            i = min(ranks)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    # In paths a piece is its id; a character outside the vocabulary is minus one less its code point.

    def joins(self, a: int, b: int) -> bool:
        """Whether b may follow a: the weight of the step is 0."""
        if a < 0 or b < 0:
            return True
        found = self.pairs.get(a << 20 | b)
        if found is None:
            x, y = self.piece[a], self.piece[b]
            found = self.pairs[a << 20 | b] = self.merged(x + y) == [x, y]
        return found

    def single(self, c: str) -> int:
        i = self.ids.get(c)
        return -1 - ord(c) if i is None else i

    def pieces_at(self, text: str, end: int) -> Iterator[tuple[int, int]]:
        """Pieces of the lattice that end at a position, with their lengths, longest first."""
        for n in self.lengths.get(text[end - 2 : end], ()) if end > 1 else ():
            if n <= end and (i := self.whole.get(text[end - n : end])) is not None:
                yield i, n
        if end:
            yield self.single(text[end - 1]), 1

    def path(self, text: str) -> list[int]:
        """The path of weight 0 through a text of its own, longest pieces tried first.

        Every prefix has one such path, so a position from which the end was not reached is never tried again.
        """
        pairs, n = self.pairs.get, len(text)
        out, untried, dead = [], [], set()
        at, last = 0, -1
        while at < n:
            found, node, to = [], self.trie, at
            while to < n and (node := node.get(text[to])) is not None:
                to += 1
                i = node.get(None)
                if i is not None:
                    found.append((to, i))
            if not found or found[0][0] != at + 1:
                found.insert(0, (at + 1, self.single(text[at])))
            while True:
                if not found:
                    dead.add(at)
                    out.pop()
                    at, found = untried.pop()
                    last = out[-1] if out else -1
                    continue
                to, i = found.pop()
                if dead and to in dead:
                    continue
                if last < 0 or i < 0:
                    break
                joins = pairs(last << 20 | i)
                if joins or joins is None and self.joins(last, i):
                    break
            out.append(i)
            untried.append((at, found))
            at, last = to, i
        return out

    def numbers(self, path: list[int]) -> bytes:
        if path and min(path) < 0:
            path = [j for i in path for j in ([i] if i >= 0 else [self.byte_id[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")])]
        return array("I", path).tobytes()

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = self.words_before.get(word)
            if found is None:
                found = self.numbers(self.path(word))
            if len(word) <= KEPT_LENGTH:
                self.words[word] = found
        return found

    def tidy(self) -> None:
        if len(self.words) > KEPT:
            self.words_before, self.words = self.words, {}
        if len(self.pairs) > 2 * KEPT:
            self.pairs.clear()

    def encode(self, normal: str) -> bytes:
        """Ids of a text in normal form that begins and ends with a document or a part of its own."""
        return b"".join(map(self.word, self.parts.findall(normal)))

    # chunks of giant documents

    def states(self, text: str, at: int) -> list[tuple[int, int | None]]:
        """States at a boundary: where a piece ends, counted back from it, and the piece; at 0 the beginning."""
        if at == 0:
            return [(0, None)]
        return [(end - at, i) for end in range(max(1, at - self.longest + 1), at + 1) for i, _ in self.pieces_at(text, end)]

    def _run(self, text: str, entries: dict[int, dict], first: int, stop: int) -> dict[int, dict]:
        """Nodes (end, last piece) up to stop that entries reach, each with the set of entries, as bits, on a path of weight 0."""
        nodes = {end: dict(found) for end, found in entries.items()}
        for end in range(first + 1, stop + 1):
            here = {}
            for i, n in self.pieces_at(text, end):
                before = nodes.get(end - n)
                bits = 0
                for last, reached in before.items() if before else ():
                    if last is None or self.joins(last, i):
                        bits |= reached
                if bits:
                    here[i] = bits
            if here:
                nodes[end] = here
        return nodes

    @staticmethod
    def _cuts(text: str, left: int, limit: int) -> tuple[int, int] | None:
        """The first position after left, and the last up to limit, where no piece can span."""
        found = [left + m.start() for m in re.finditer(f"(?<=[^{MARK}]){MARK}", text[left:limit])]
        return (found[0], found[-1]) if found else None

    def _entries(self, states: list[tuple[int, int | None]], left: int) -> dict[int, dict]:
        out: dict[int, dict] = {}
        for i, (back, piece) in enumerate(states):
            out.setdefault(left + back, {})[piece] = 1 << i
        return out

    def matrix(self, text: str, left: int, final: bool) -> np.ndarray:
        """Weights from the states at left to those at the end of text; at the document's end to the one state of ending there."""
        states, n = self.states(text, left), len(text)
        # the states at the end all lie behind the last cut
        cuts = self._cuts(text, left, n - self.longest)
        entries = self._entries(states, left)
        if cuts is None:
            nodes = self._run(text, entries, left, n)
        else:
            reached = 0
            for bits in self._run(text, entries, left, cuts[0]).get(cuts[0], {}).values():
                reached |= bits
            nodes = self._run(text, {cuts[1]: {None: reached}}, cuts[1], n)
        if final:
            masks = [0]
            for bits in nodes.get(n, {}).values():
                masks[0] |= bits
        else:
            masks = [nodes.get(n + back, {}).get(piece, 0) for back, piece in self.states(text, n)]
        return np.array([[YES if m >> i & 1 else NO for m in masks] for i in range(len(states))], np.float32).reshape(len(states), len(masks))

    def trace(self, text: str, left: int, entry: tuple[int, int | None], leave: tuple[int, int | None] | None) -> bytes:
        """Ids of the pieces after entry's, up to leave's (or the document's end)."""
        start = left + entry[0]
        stop = len(text) + leave[0] if leave else len(text)
        cuts = self._cuts(text, start, stop)
        head_end = cuts[0] if cuts else stop
        out = [self.numbers(self._back(text, {start: {entry[1]: 1}}, start, head_end, leave[1] if leave and not cuts else None))]
        if cuts:
            out.append(self.encode(text[cuts[0] : cuts[1]]))
            out.append(self.numbers(self._back(text, {cuts[1]: {None: 1}}, cuts[1], stop, leave[1] if leave else None)))
        return b"".join(out)

    def _back(self, text: str, entries: dict[int, dict], start: int, stop: int, last: int | None) -> list[int]:
        nodes, out, end = self._run(text, entries, start, stop), [], stop
        while end > start:
            piece = last if last is not None else next(iter(nodes[end]))
            out.append(piece)
            end -= self.size[piece] if piece >= 0 else 1
            last = None
            if end > start:
                last = next(p for p in nodes[end] if self.joins(p, piece))
        return out[::-1]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.plain[i] for i in ids.tolist()])
        return (text[1:] if text.startswith(b" ") else text).decode("utf-8", "replace")


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """One for each worker process."""
    if path not in _models:
        _models.clear()
        _models[path] = Model(path)
    _models[path].tidy()
    return _models[path]


def normal(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def _lists(parts: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("digest", F.xxhash64("text"))


def _encoded(batch: pa.RecordBatch, path: str) -> pa.RecordBatch:
    m = model(path)
    ids = [m.encode(normal(t)) for t in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), _lists(ids)], names=["doc_id", "digest", "ids"])


def encode(docs: DataFrame, path: str, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """doc_id, digest (xxhash64 of the text) and ids (array<int>) of every row."""
    rows = _keyed(docs)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            yield _encoded(batch, path)

    giant = F.length("text") >= chunk
    return rows.where(~giant).mapInArrow(short, "doc_id bigint, digest bigint, ids array<int>").unionByName(_giants(rows.where(giant), path, chunk, block))


def _giants(rows: DataFrame, path: str, chunk: int, block: int) -> DataFrame:
    key = "doc_id bigint, digest bigint, length bigint"
    keys = ["doc_id", "digest", "length"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = 2 * model(path).longest
        for batch in common.slices(batches, "text", SLICE_BYTES):
            for doc_id, text, digest in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "digest")]):
                whole = normal(text)
                at = list(range(0, len(whole), chunk))
                for k in range(0, len(at), 256):
                    part = at[k : k + 256]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id] * n, pa.int64()), pa.array([digest] * n, pa.int64()), pa.array([len(whole)] * n, pa.int64()), pa.array([a // chunk for a in part], pa.int64()), pa.array([min(a, back) for a in part], pa.int64()), pa.array([a + chunk >= len(whole) for a in part]), pa.array([whole[max(0, a - back) : a + chunk] for a in part])],
                        names=[*keys, "number", "left_chars", "final", "piece"],
                    )

    chunks = rows.mapInArrow(split, f"{key}, number bigint, left_chars bigint, final boolean, piece string")
    # rows that repeat are computed once
    chunks = common.cut(chunks.repartition(common.partitions(rows.sparkSession), *keys, "number").dropDuplicates([*keys, "number"]), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, left, final in zip(*[batch.column(c).to_pylist() for c in ("piece", "left_chars", "final")]):
                w = model(path).matrix(text, left, final)
                found.append((w.shape[0], w.shape[1], (w == YES).astype(np.uint8).tobytes()))
            a, b, w = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*keys, "number")], pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(w, pa.binary())], names=[*keys, "number", "rows", "cols", "weights"])

    def unpacked(table) -> list[np.ndarray]:
        return [np.where(np.frombuffer(w, np.uint8).reshape(a, b) == 1, YES, NO).astype(np.float32) for a, b, w in zip(table.rows, table.cols, table.weights)]

    def packed(w: np.ndarray) -> bytes:
        return (w == YES).astype(np.uint8).tobytes()

    def combine(group, table):
        import pandas as pd

        table = table.sort_values("number")
        whole = None
        for w in unpacked(table):
            whole = w if whole is None else product(whole, w)
        return pd.DataFrame([[*group, whole.shape[0], whole.shape[1], packed(whole)]], columns=[*keys, "block", "rows", "cols", "weights"])

    def scan(every: list[np.ndarray], inward: np.ndarray, outward: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """At each boundary the weights of reaching its states, and of the end being reached from them."""
        forward, backward = [inward], [outward]
        for x in every:
            forward.append(product(forward[-1], x))
        for x in every[::-1]:
            backward.append(product(x, backward[-1]))
        return forward, backward[::-1]

    def over_blocks(group, table):
        import pandas as pd

        table = table.sort_values("block")
        forward, backward = scan(unpacked(table), np.zeros((1, 1), np.float32), np.zeros((1, 1), np.float32))
        return pd.DataFrame([[*group, k, packed(i), packed(o)] for k, i, o in zip(table.block, forward, backward[1:])], columns=[*keys, "block", "inward", "outward"])

    def over_chunks(group, table):
        import pandas as pd

        table = table.sort_values("number")
        weights = lambda x: np.where(np.frombuffer(x, np.uint8) == 1, YES, NO).astype(np.float32)
        forward, backward = scan(unpacked(table), weights(table.inward.iloc[0])[None, :], weights(table.outward.iloc[0])[:, None])
        # of the states on the path, the last before each boundary
        on_path = [int(np.flatnonzero(f[0] + b[:, 0] == YES)[-1]) for f, b in zip(forward, backward)]
        return pd.DataFrame([[*group[:3], n, i, o] for n, i, o in zip(table.number, on_path, on_path[1:])], columns=[*keys, "number", "entry", "leave"])

    w = common.cut(chunks.select(*keys, "number", "left_chars", "final", "piece").mapInArrow(matrices, f"{key}, number bigint, rows bigint, cols bigint, weights binary").withColumn("block", F.floor(F.col("number") / block)), "matrices")
    blocks = w.groupBy(*keys, "block").applyInPandas(combine, f"{key}, block bigint, rows bigint, cols bigint, weights binary")
    ends = blocks.groupBy(*keys).applyInPandas(over_blocks, f"{key}, block bigint, inward binary, outward binary")
    joined = w.alias("w").join(ends.alias("e"), [F.col(f"w.{n}").eqNullSafe(F.col(f"e.{n}")) for n in (*keys, "block")]).select("w.*", "e.inward", "e.outward")
    reached = joined.groupBy(*keys, "block").applyInPandas(over_chunks, f"{key}, number bigint, entry int, leave int")
    placed = chunks.alias("c").join(reached.alias("r"), [F.col(f"c.{n}").eqNullSafe(F.col(f"r.{n}")) for n in (*keys, "number")]).select("c.*", "r.entry", "r.leave")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, left, final, entry, leave in zip(*[batch.column(c).to_pylist() for c in ("piece", "left_chars", "final", "entry", "leave")]):
                m = model(path)
                found.append(m.trace(text, left, m.states(text, left)[entry], None if final else m.states(text, len(text))[leave]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*keys, "number")], _lists(found)], names=[*keys, "number", "ids"])

    parts = placed.mapInArrow(trace, f"{key}, number bigint, ids array<int>")
    whole = parts.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("number", "ids"))), lambda x: x["ids"])).alias("ids"))
    times = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).cast("int").alias("times"))
    both = whole.alias("a").join(times.alias("t"), [F.col("a.doc_id").eqNullSafe(F.col("t.doc_id")), F.col("a.digest") == F.col("t.digest")])
    return both.select("a.doc_id", "a.digest", "a.ids", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc_id", "digest", "ids")


_DECODED = "doc_id bigint, digest bigint, n_tokens bigint, ids_crc32 bigint, text string"


def _decoded(batch: pa.RecordBatch, path: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    lists = batch.column("ids")
    bounds, values = np.asarray(lists.offsets), np.asarray(lists.values)
    m = model(path)
    for i in range(0, len(lists), 500):
        spans = [values[a:b] for a, b in zip(bounds[i : i + 500], bounds[i + 1 : i + 501])]
        columns = [batch.column("doc_id").slice(i, 500), batch.column("digest").slice(i, 500), pa.array([len(s) for s in spans], pa.int64()), pa.array([zlib.crc32(s.astype("<u4").tobytes()) for s in spans], pa.int64()), pa.array([m.decode(s) for s in spans], pa.string())]
        yield pa.RecordBatch.from_arrays(columns + [lists.slice(i, 500)] * with_ids, names=["doc_id", "digest", "n_tokens", "ids_crc32", "text"] + ["ids"] * with_ids)


def decode(encoded: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, digest, n_tokens, ids_crc32, text and, if asked for, ids of every row that encode() gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _decoded(batch, path, with_ids)

    return encoded.mapInArrow(run, _DECODED + ", ids array<int>" * with_ids)


def round_trip(docs: DataFrame, path: str, with_ids: bool = False, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """What decode() gives of what encode() gives; documents that are not split are decoded from their ids where they were encoded."""
    rows = _keyed(docs)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE_BYTES):
            yield from _decoded(_encoded(batch, path), path, with_ids)

    giant = F.length("text") >= chunk
    found = rows.where(~giant).mapInArrow(short, _DECODED + ", ids array<int>" * with_ids)
    return found.unionByName(decode(_giants(rows.where(giant), path, chunk, block), path, with_ids))
