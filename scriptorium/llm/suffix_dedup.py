"""Passages that repeat across documents, removed byte by byte: every byte under a 50-byte string that also starts in a document with a smaller id.

Suffixes are compared to a depth of LENGTH bytes in buckets, one at a time, in passes of bounded memory:

0. Documents that equal one with a smaller id, by SHA-256, lose every byte; they are settled and take no further part.
1. Every window of LENGTH bytes names an anchor, the GRAM-byte string in it with the least hash (the first, if several have
   it). Equal windows have equal anchors at equal places, so only suffixes around anchors that occur in several documents
   need to be sorted. Anchors go to buckets by their hash, packed; what repeats inside one task is settled there.
2. Documents with repeated anchors are read again, and each such anchor goes to its bucket with the bytes that its
   windows can reach and the range of windows that name it.
3. A bucket's suffixes are sorted by a difference cover: columns of the bucket's matrix whose number modulo PERIOD is in the
   cover get ranks of the GRAM-byte strings that begin there, once. A window's key is then the few bytes before its first
   cover column, the ranks of cover columns that reach through it, and the few bytes behind: ties as long as the
   window are resolved by ranks, never by comparing strings. The first of each run of equal keys in order of
   id is its smallest document; windows of larger ids are to be removed. Equal windows lie at equal places around their
   anchors, so windows of one place are sorted apart: this is no single order of all suffixes, and no ranks of different
   offsets are ever compared, as a suffix array would.
4. Documents with such windows are read once more and cut; all others are hashed as they are.

Documents are moved in passes 2 and 4 only if they have something to settle: the list of those documents is broadcast up to
BROADCAST_DOCS of them, beyond it all documents move. No step emits pairs.

Defined results: a null text is empty; texts under LENGTH bytes keep everything; a null doc_id is smaller than all others;
rows with equal doc_id do not affect each other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM  # an anchor begins at most so far after its window does
#: Any two numbers differ, modulo PERIOD, as exactly two of the cover do.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
WIDTH = 2 * SPAN + GRAM
BROADCAST_DOCS = common.BROADCAST_ROWS
#: Windows hashed at once, and bytes of text settled together in a task.
SEGMENT, BLOCK_BYTES, BLOCK_DOCS = 1 << 16, 4 << 20, 60_000
NOBODY = 65_535
#: Buckets of contexts for each of anchors: contexts are larger.
FINER = 3

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_P = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << i, 2**64)) for i in range(4)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position."""
    h1 = _BYTE[data]
    h2 = h1[:-1] * _P[0] + h1[1:]
    h4 = h2[:-2] * _P[1] + h2[2:]
    h8 = h4[:-4] * _P[2] + h4[4:]
    h16 = h8[:-8] * _P[3] + h8[8:]
    h = h16[:-4] * _P[2] + h4[16:]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Position, 48-bit hash, first and last window of each run of windows that name an anchor. ends: of the documents in data."""
    found = []
    low = np.uint64(SEGMENT * 2 - 1)
    for s in range(0, len(data) - LENGTH + 1, SEGMENT):
        part = data[s : s + SEGMENT + LENGTH - 1]
        h = gram_hashes(part)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        for step in (1, 2, 4, 8, SPAN + 1 - 16):
            key = np.minimum(key[:-step], key[step:])
        at = (key & low).astype(np.int64)
        valid = np.ones(len(at), bool)
        near = ends[np.searchsorted(ends, s, "right") : np.searchsorted(ends, s + len(at) + LENGTH, "right")] - s
        cut = (near[:, None] + np.arange(1 - LENGTH, 0)).ravel()
        valid[cut[(cut >= 0) & (cut < len(at))]] = False
        w = np.flatnonzero(valid)
        if not len(w):
            continue
        a = at[w]
        first = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(w, prepend=-2) != 1))
        last = np.append(first[1:], len(w)) - 1
        found.append((a[first] + s, h[a[first]] >> np.uint64(16), w[first] + s, w[last] + s))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and where each text ends."""
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _planes(values: np.ndarray) -> bytes:
    """Sorted 48-bit numbers as planes of bytes of their differences: the high planes compress to nothing."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :6] = planes.T
    return np.cumsum(out.view("<u8")[:, 0], dtype=np.uint64)


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    """Buckets of even size: the hashes of anchors are least ones, so they are mixed once more."""
    mixed = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
    return (mixed * np.uint64(n) >> np.uint64(40)).astype(np.int64)


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key and the positions that hold it."""
    order = np.argsort(keys, kind="stable")
    bounds = np.flatnonzero(np.diff(keys[order], prepend=-1, append=-1) if len(keys) else [])
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield int(keys[order[a]]), order[a:b]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """code of every document and its bytes, in blocks of bounded size."""
    codes, texts, size = [], [], 0
    for batch in common.slices(batches, "text", BLOCK_BYTES):
        found = [t.encode("utf-8", "surrogatepass") for t in common.texts(batch.column("text"))]
        for code, text in zip(batch.column("code").to_pylist(), found):
            codes.append(code)
            texts.append(text)
            size += len(text)
            if size >= BLOCK_BYTES or len(codes) >= BLOCK_DOCS:
                yield np.array(codes, np.int64), texts
                codes, texts, size = [], [], 0
                common.give_back()
    if codes:
        yield np.array(codes, np.int64), texts


# pass 1

_SEEN = "bucket int, settled boolean, hashes binary, owners binary, codes binary"
_REPEATED = "grp int, codes binary, hashes binary"


def _seen(batches: Iterator[pa.RecordBatch], n: int, groups: int) -> Iterator[pa.RecordBatch]:
    for codes, texts in _blocks(batches):
        data, ends = joined(texts)
        at, hashes, _, _ = anchors(data, ends)
        owner = np.searchsorted(ends, at, "right")
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        new = (np.diff(hashes, prepend=~hashes[:1]) != 0) | (np.diff(owner, prepend=-1) != 0)
        hashes, owner = hashes[new], owner[new]
        first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
        count = np.diff(np.append(first, len(hashes)))
        # an anchor of several documents here is settled for them; one entry stands for all of them elsewhere
        several = np.repeat(count > 1, count)
        rows = [(g % n, True, b"", codes[owner[several][i]].astype("<u4").tobytes(), hashes[several][i].astype("<u8").tobytes(), g) for g, i in _groups(codes[owner[several]] % groups)]
        one, who = hashes[first], np.where(count > 1, NOBODY, owner[first]).astype("<u2")
        for b, i in _groups(_bucket(one, n)):
            used, local = np.unique(who[i], return_inverse=True)
            named = np.where(used == NOBODY, 0, codes[np.minimum(used, len(codes) - 1)]).astype("<u4")
            local = np.where(who[i] == NOBODY, NOBODY, local).astype("<u2")
            rows.append((b, False, _planes(one[i]), local.tobytes(), named.tobytes(), 0))
        if rows:
            b, settled, h, o, c, g = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(settled), pa.array(h, pa.binary()), pa.array(o, pa.binary()), pa.array(c, pa.binary())], names=[x.split()[0] for x in _SEEN.split(", ")])


def _repeated(table: pa.Table, n: int) -> pa.Table:
    """Of one bucket: the anchors that several blocks hold, by their documents' group."""
    codes, hashes, every, who = [], [], [], []
    for settled, h, o, c in zip(*[table.column(x).to_pylist() for x in ("settled", "hashes", "owners", "codes")]):
        if settled:
            codes.append(np.frombuffer(o, "<u4"))
            hashes.append(np.frombuffer(c, "<u8"))
            continue
        owner = np.frombuffer(o, "<u2")
        named = np.append(np.frombuffer(c, "<u4").astype(np.int64), -1)
        every.append(_unplanes(h))
        who.append(named[np.where(owner == NOBODY, len(named) - 1, owner)])
    if every:
        h, w = np.concatenate(every), np.concatenate(who)
        order = np.argsort(h, kind="stable")
        h, w = h[order], w[order]
        same = h[1:] == h[:-1]
        keep = (np.append(same, False) | np.append(False, same)) & (w >= 0)
        codes.append(w[keep].astype("<u4"))
        hashes.append(h[keep])
    codes, hashes = np.concatenate(codes), np.concatenate(hashes)
    rows = [(g, codes[i].astype("<u4").tobytes(), hashes[i].astype("<u8").tobytes()) for g, i in _groups(codes.astype(np.int64) % n)]
    g, c, h = zip(*rows) if rows else ((), (), ())
    common.give_back()
    return pa.Table.from_arrays([pa.array(g, pa.int32()), pa.array(c, pa.binary()), pa.array(h, pa.binary())], names=["grp", "codes", "hashes"])


# pass 2

_CONTEXTS = "bucket int, settled boolean, ids binary, codes binary, at binary, windows binary, bytes binary"


def _pairing(codes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One number for a document's code and an anchor; a chance coincidence only adds a candidate."""
    return hashes ^ (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _contexts(docs: pa.Table, wanted: pa.Table, n: int, buckets: int) -> pa.Table:
    """Of one group of documents: its repeated anchors with the bytes around, by bucket."""
    rows = []
    if docs.num_rows and wanted.num_rows:
        codes = np.frombuffer(b"".join(wanted.column("codes").to_pylist()), "<u4")
        known = np.unique(_pairing(codes, np.frombuffer(b"".join(wanted.column("hashes").to_pylist()), "<u8")))
        texts = [t.encode("utf-8", "surrogatepass") for t in common.texts(docs.column("text"))]
        ids, own = (np.array(docs.column(c).to_pylist(), np.int64) for c in ("id", "code"))
        first = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= BLOCK_BYTES // 2 or i + 1 == len(texts):
                rows += _block_contexts(texts[first : i + 1], ids[first : i + 1], own[first : i + 1], known, n, buckets)
                first, size = i + 1, 0
    common.give_back()
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, [pa.int32(), pa.bool_(), *[pa.binary()] * 5])], names=[x.split()[0] for x in _CONTEXTS.split(", ")])


def _block_contexts(texts, ids, codes, known, n, buckets) -> list[tuple]:
    data, ends = joined(texts)
    at, hashes, low, high = anchors(data, ends)
    owner = np.searchsorted(ends, at, "right")
    keep = np.isin(_pairing(codes[owner], hashes), known)
    at, hashes, low, high, owner = (x[keep] for x in (at, hashes, low, high, owner))
    if not len(at):
        return []
    padded = np.concatenate([np.zeros(SPAN, np.uint8), data, np.zeros(SPAN, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[at]
    begins = (np.append(0, ends[:-1]))[owner]
    # bytes of other documents are never reached by a window; they go, so that equal contexts are equal
    column = np.arange(WIDTH) - SPAN
    around = np.where((column >= (low - at)[:, None]) & (column < (high - at + LENGTH)[:, None]), around, 0).astype(np.uint8)
    windows = np.stack([low - at + SPAN, high - at + SPAN], 1).astype(np.uint8)
    # where documents here share all bytes and windows of an anchor, the smallest stands for all
    keys = [*_ints(np.concatenate([around, windows], 1)), hashes]
    order = np.lexsort([ids[owner], *keys])
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    first = np.flatnonzero(new)
    sorted_ids = ids[owner][order]
    settled = np.zeros(len(at), bool)
    settled[order] = sorted_ids > np.repeat(sorted_ids[first], np.diff(np.append(first, len(order))))
    out = []
    for done in (True, False):
        where = np.flatnonzero(settled == done)
        key = (codes[owner[where]] % n) if done else _bucket(hashes[where], buckets)
        for b, j in _groups(key):
            i = where[j]
            packed = (ids[owner[i]].astype("<i8"), codes[owner[i]].astype("<u4"), (at[i] - begins[i]).astype("<i8"), windows[i])
            out.append((b, done, *[x.tobytes() for x in packed], b"" if done else around[i].tobytes()))
    return out


# pass 3

_REMOVED = "grp int, ids binary, codes binary, at binary, masks binary"


def _ints(columns: np.ndarray) -> list[np.ndarray]:
    """Bytes side by side as 64-bit numbers."""
    out = []
    for i in range(0, columns.shape[1], 8):
        part = np.zeros((len(columns), 8), np.uint8)
        part[:, : columns[:, i : i + 8].shape[1]] = columns[:, i : i + 8]
        out.append(part.view("<u8")[:, 0])
    return out


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(new)
    return out


def later_windows(around: np.ndarray, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of contexts a bit for each window that also begins in a row with a smaller id. Sorts by difference-cover ranks."""
    covered = [c for c in range(WIDTH - GRAM + 1) if c % PERIOD in COVER]
    rank = {c: _ranks(_ints(around[:, c : c + GRAM])) for c in covered}
    masks = np.zeros(len(around), np.uint32)
    for o in range(SPAN + 1):
        rows = np.flatnonzero((windows[:, 0] <= o) & (o <= windows[:, 1]))
        if len(rows) < 2:
            continue
        inside = [c for c in covered if o <= c <= o + SPAN]
        chain = [inside[0]]
        while chain[-1] != inside[-1]:  # the furthest column that the strings so far reach
            chain.append(max(c for c in inside if c <= chain[-1] + GRAM))
        keys = [rank[c][rows] for c in chain]
        for a, b in ((o, chain[0]), (chain[-1] + GRAM, o + LENGTH)):
            if a < b:
                keys += _ints(around[rows, a:b])
        order = np.lexsort([ids[rows], *keys])
        new = np.zeros(len(order), bool)
        new[0] = True
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        first = np.flatnonzero(new)
        sorted_ids = ids[rows][order]
        later = sorted_ids > np.repeat(sorted_ids[first], np.diff(np.append(first, len(order))))
        masks[rows[order[later]]] |= np.uint32(1 << o)
    return masks


def _removed(table: pa.Table, n: int) -> pa.Table:
    """Of one bucket: for each anchor of a document the windows to remove, by the documents' group."""
    fields: list[list[np.ndarray]] = [[] for _ in range(4)]
    waiting: list[list[np.ndarray]] = [[] for _ in range(5)]
    for settled, *values in zip(*[table.column(x).to_pylist() for x in ("settled", "ids", "codes", "at", "windows", "bytes")]):
        read = [np.frombuffer(v, t) for v, t in zip(values, ("<i8", "<u4", "<i8", np.uint8, np.uint8))]
        read[3] = read[3].reshape(-1, 2)
        if settled:
            low, high = read[3].T.astype(np.uint64)
            masks = ((np.uint64(2) << high) - (np.uint64(1) << low)).astype(np.uint32)
            for f, x in zip(fields, (*read[:3], masks)):
                f.append(x)
        else:
            read[4] = read[4].reshape(-1, WIDTH)
            for f, x in zip(waiting, read):
                f.append(x)
    del table
    if waiting[0]:
        ids, codes, at, windows, around = (np.concatenate(x) for x in waiting)
        waiting.clear()
        masks = later_windows(around, windows, ids)
        some = masks > 0
        for f, x in zip(fields, (ids, codes, at, masks)):
            f.append(x[some])
    ids, codes, at, masks = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in fields)
    rows = [(g, ids[i].astype("<i8").tobytes(), codes[i].astype("<u4").tobytes(), at[i].astype("<i8").tobytes(), masks[i].astype("<u4").tobytes()) for g, i in _groups(codes.astype(np.int64) % n)]
    common.give_back()
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, [pa.int32(), *[pa.binary()] * 4])], names=[x.split()[0] for x in _REMOVED.split(", ")])


# pass 4


def cut_out(text: bytes, at: np.ndarray, masks: np.ndarray) -> tuple[bytes, int, int]:
    """What stays of text, bytes removed, and in how many runs."""
    change = np.zeros(len(text) + 1, np.int64)
    for o in range(SPAN + 1):
        starts = at[masks >> np.uint32(o) & np.uint32(1) == 1] - SPAN + o
        change += np.bincount(starts, minlength=len(change)) - np.bincount(starts + LENGTH, minlength=len(change))
    gone = np.cumsum(change[:-1]) > 0
    runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


_RESULT = "id bigint, digest bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _result(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, [*[pa.int64()] * 5, pa.string(), pa.binary()])], names=[x.split()[0] for x in _RESULT.split(", ")])


def _kept(docs: pa.Table, removed: pa.Table, with_bytes: bool) -> pa.Table:
    rows = []
    ids, codes, at, masks = (np.frombuffer(b"".join(removed.column(c).to_pylist()), t) for c, t in (("ids", "<i8"), ("codes", "<u4"), ("at", "<i8"), ("masks", "<u4")))
    order = np.lexsort((codes, ids))
    ids, codes, at, masks = (x[order] for x in (ids, codes, at, masks))
    for i, digest, code, text in zip(*[docs.column(c).to_pylist() for c in ("id", "digest", "code", "text")]):
        raw = (text or "").encode("utf-8", "surrogatepass")
        a, b = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
        a, b = a + np.searchsorted(codes[a:b], code, "left"), a + np.searchsorted(codes[a:b], code, "right")
        kept, gone, runs = cut_out(raw, at[a:b], masks[a:b]) if b > a else (raw, 0, 0)
        rows.append((i, digest, len(raw), gone, runs, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
    common.give_back()
    return _result(rows)


def _untouched(batches: Iterator[pa.RecordBatch], with_bytes: bool) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, "text", BLOCK_BYTES):
        rows = []
        for i, digest, text in zip(*[batch.column(c).to_pylist() for c in ("id", "digest", "text")]):
            raw = (text or "").encode("utf-8", "surrogatepass")
            rows.append((i, digest, len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw if with_bytes else None))
        yield from _result(rows).to_batches()


def _keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(common.NULL_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    return rows.withColumn("code", F.xxhash64("id", "digest").bitwiseAND(F.lit(0xFFFFFFFF)))


def _codes(table: DataFrame, keep: bool = False) -> DataFrame:
    """The distinct codes in packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("codes").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(packed, "<u4")).astype(np.int64))], names=["code"])

    return common.cut(table.select("codes").mapInArrow(run, "code bigint").distinct(), "codes", keep)


def removals(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """id (doc_id, null as the least number), n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes kept, of every row."""
    n = common.partitions(docs.sparkSession)
    every = _keyed(docs)

    with common.scratch(docs.sparkSession):
        # whole copies of a document with a smaller id: nothing of them stays, and nothing starts in them first
        known = common.cut(every.select("id", "digest", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("bigint").alias("n_bytes")), "digests")
        long = known.where(F.col("n_bytes") >= LENGTH)
        least = long.groupBy("sha").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n")).where("least < most").drop("most")
        copied = common.cut(common.lookup(long, least, "sha", "n", long.count()).where("id > least").select("id", "digest", "n_bytes"), "copies", keep=True)
        rows = every.join(common.small(copied.select("id", "digest").distinct(), BROADCAST_DOCS), ["id", "digest"], "left_anti")
        none = F.lit(hashlib.sha256(b"").hexdigest())
        gone = copied.select("id", "digest", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("bigint").alias("n_spans"), none.alias("kept_sha256"), F.lit(b"" if with_bytes else None).cast("binary").alias("kept"))

        groups, buckets = 2 * n, FINER * n
        seen = rows.select("code", "text").mapInArrow(lambda b: _seen(b, n, groups), _SEEN)
        group = F.pmod(F.col("code"), F.lit(groups)).cast("int").alias("grp")
        with common.batches_of(docs.sparkSession, "2m"):
            repeated = common.cut(seen.groupBy("bucket").applyInArrow(lambda t: _repeated(t, groups), _REPEATED), "repeated")
            held = rows.join(common.small(_codes(repeated), BROADCAST_DOCS), "code", "left_semi").select("id", "code", "text", group)
            contexts = held.groupBy("grp").cogroup(repeated.groupBy("grp")).applyInArrow(lambda a, b: _contexts(a, b, groups, buckets), _CONTEXTS)
            removed = common.cut(contexts.groupBy("bucket").applyInArrow(lambda t: _removed(t, groups), _REMOVED), "removed", keep=True)

        codes = common.small(_codes(removed, keep=True), BROADCAST_DOCS)
    held = rows.join(codes, "code", "left_semi").select("id", "digest", "code", "text", group)
    changed = held.groupBy("grp").cogroup(removed.groupBy("grp")).applyInArrow(lambda a, b: _kept(a, b, with_bytes), _RESULT)
    rest = rows.join(codes, "code", "left_anti").select("id", "digest", "text").mapInArrow(lambda b: _untouched(b, with_bytes), _RESULT)
    return changed.unionByName(rest).unionByName(gone)


def cleaned(docs: DataFrame) -> DataFrame:
    """docs with repeated passages cut from text (what is left of a cut character goes too) and n_chars, if there, set anew."""
    every, kinds, docs = docs.columns, docs.schema, common.packed(docs, "doc_id", "text")
    found = removals(docs, True).where("n_removed > 0").groupBy(F.col("id").alias("__id"), F.col("digest").alias("__digest")).agg(F.first("kept").alias("__kept"))
    own = {"__id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(common.NULL_ID)), "__digest": F.xxhash64(F.coalesce("text", F.lit("")))}
    both = docs.withColumns(own).join(found, ["__id", "__digest"], "left")
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if k is None else k.decode("utf-8", "ignore") for t, k in zip(batch.column("text").to_pylist(), batch.column("__kept").to_pylist())]
            values = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(values, names=columns)

    out = common.unpacked(both.select(*columns, "__kept").mapInArrow(run, docs.schema), every, "doc_id", "text")
    return out.withColumn("n_chars", F.length("text").cast(kinds["n_chars"].dataType)) if "n_chars" in every else out
