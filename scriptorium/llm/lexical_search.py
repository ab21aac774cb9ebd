"""Ranked lexical search: documents by the weights of the terms that they share with an item.

Documents are indexed where they are read: a shard is a run of documents of one task, in ascending doc_id order, of about SHARD_BYTES of
text (a longer document is whole). For each term of a shard there is one row with its postings: gaps between the documents' numbers in
the shard and occurrences, as bytes of seven bits. The row of the empty term holds the shard's doc_ids and lengths. The index has all
terms and is a table like others; a search reads the rows of the items' terms.

A shard is searched document at a time: the lists of an item's terms are merged by a heap of their next documents, and a heap of the
best documents so far, keyed by score and then by doc_id, is bounded by the number asked for. Terms whose greatest scores together cannot
lift a document over the last of that heap leave the merge; their lists are looked into only for documents that may still qualify. What
the shards found is merged by score and doc_id.

Defined results: terms are maximal matches of letters A to Z (as a to z), digits and characters beyond ASCII; a null text has none and is
no document of the statistics, as is one without terms. Rows of one doc_id are documents of their own, null comes before other ids; rows
of one item_id are one item of the terms of all. Items without terms and terms in no document give nothing; further columns are ignored.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush, heappushpop, heapreplace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Documents that are returned for each item.
BEST = 50
#: Bytes of text of a shard; items whose lists are merged in one task; rows of the index that go on at once.
SHARD_BYTES, ITEMS, ROWS = 32 << 20, 1000, 20_000
SLICE_BYTES = 2 << 20
#: Fixed values of the score.
SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_SHARE = 1_000_000_000, 1000, 20, 50
INDEX = "shard bigint, term string, df bigint, total bigint, postings binary"
#: Separators to spaces, A to Z to small letters: what split() then gives are the terms, in UTF-8.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values (below 2**35) as bytes of seven bits, the last of each without the top bit, and where each value begins."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 5):
        size += values >= np.uint64(1 << 7 * k)
    begins = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(begins[-1], np.uint8)
    for k in range(5):
        at = np.flatnonzero(size > k)
        part = (values[at] >> np.uint64(7 * k)) & np.uint64(127)
        out[begins[at] + k] = part | np.where(size[at] > k + 1, np.uint64(128), np.uint64(0))
    return out, begins


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    begins = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    place = np.arange(len(raw)) - np.repeat(begins, last - begins + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), begins) if len(last) else np.zeros(0, np.int64)


class _Shard:
    """The documents of a shard as they are read: ids, and for each its different terms, by number, and their occurrences."""

    def __init__(self):
        self.ids: list[int] = []
        self.vocabulary: dict[bytes, int] = {}
        self.term, self.tf, self.held, self.lengths, self.size = array("i"), array("q"), array("q"), array("q"), 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        found = Counter(terms(text))
        number = self.vocabulary.setdefault
        self.ids.append(common.NULL_ID if doc_id is None else doc_id)
        self.term.extend([number(t, len(self.vocabulary)) for t in found])
        self.tf.extend(found.values())
        self.held.append(len(found))
        self.lengths.append(sum(found.values()))
        self.size += len(text or b"")


def _postings(number: int, shard: _Shard) -> Iterator[pa.RecordBatch]:
    """Rows of the index of one shard: the documents' row, then one for each term."""
    ids, held, lengths = (np.array(x, np.int64) for x in (shard.ids, shard.held, shard.lengths))
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    head = ids[order].astype("<i8").tobytes() + lengths[order].astype("<i8").tobytes()
    yield _rows([number], [b""], [int((held > 0).sum())], [int(lengths.sum())], pa.array([head], pa.binary()))
    total = int(held.sum())
    if not total:
        return
    term, tf, document = np.array(shard.term, np.int32), np.array(shard.tf, np.int64), np.repeat(place, held)
    by = np.lexsort((document, term))
    term, tf, document = term[by], tf[by], document[by]
    firsts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    gaps = np.diff(document, prepend=-1)
    gaps[firsts] = document[firsts] + 1
    data, begins = packed(np.stack([gaps, tf], axis=1).ravel())
    cuts = np.concatenate([begins[2 * firsts], begins[-1:]])
    names, df, sums = list(shard.vocabulary), np.diff(np.append(firsts, total)), np.add.reduceat(tf, firsts)
    for a in range(0, len(firsts), ROWS):
        b = min(a + ROWS, len(firsts))
        part = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((cuts[a : b + 1] - cuts[a]).astype(np.int32).tobytes()), pa.py_buffer(data[cuts[a] : cuts[b]].tobytes())])
        yield _rows([number] * (b - a), [names[t] for t in term[firsts[a:b]]], df[a:b], sums[a:b], part)


def _rows(shard: list[int], term: list[bytes], df, total, postings: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(df, pa.int64()), pa.array(total, pa.int64()), postings], names=["shard", "term", "df", "total", "postings"])


def index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Postings of docs (doc_id, text): a row for each shard and term, with how many documents of the shard hold it and how often in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        shard = _Shard()
        for batch in common.slices(batches, "text", SLICE_BYTES):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                shard.add(doc_id, text)
                if shard.size >= shard_bytes:
                    yield from _postings(number, shard)
                    number, shard = number + 1, _Shard()
        if shard.ids:
            yield from _postings(number, shard)
        common.give_back()

    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, INDEX)


def merge(lists: list[tuple[int, list[int], list[int]]], k: int) -> list[tuple[int, int]]:
    """The k best (score, document) with a score above 0, equal scores by ascending document. lists: (greatest score, documents, scores)."""
    lists = sorted(lists, key=lambda x: x[0])
    n = len(lists)
    bound, documents, scores = zip(*lists) if lists else ((), (), ())
    below = np.cumsum(bound).tolist()  # the most that the lists up to each give together
    ends, at = [len(d) for d in documents], [0] * n
    heap = [d[0] * n + i for i, d in enumerate(documents)]  # next document of a list, and its number
    heapify(heap)
    best: list[tuple[int, int]] = []
    first, limit = 0, 0  # lists from first on are merged; a score must be above limit
    while heap:
        document, i = divmod(heap[0], n)
        score, top = 0, document * n + n
        while heap and heap[0] < top:
            i = heap[0] - document * n
            if i < first:
                heappop(heap)
                continue
            p = at[i]
            score += scores[i][p]
            at[i] = p = p + 1
            if p < ends[i]:
                heapreplace(heap, documents[i][p] * n + i)
            else:
                heappop(heap)
        if not score:  # only lists that had left the merge were here
            continue
        for j in range(first - 1, -1, -1):
            if score + below[j] <= limit:
                break
            at[j] = p = bisect_left(documents[j], document, at[j])
            if p < ends[j] and documents[j][p] == document:
                score += scores[j][p]
        else:
            if score > limit:
                if len(best) < k:
                    heappush(best, (score, -document))
                else:
                    heappushpop(best, (score, -document))
                if len(best) == k:
                    limit = best[0][0]
                    while first < n and below[first] <= limit:
                        first += 1
                    if first == n:
                        break
    return [(s, -d) for s, d in sorted(best, reverse=True)]


def shard_best(table: pa.Table, n_docs: int, all_terms: int, k: int) -> tuple[list, list[int], list[int]]:
    """Of one shard's rows (term, w, items, postings), for each item its k best documents: items, doc_ids, scores."""
    rows = dict(zip(table.column("term").to_pylist(), zip(*(table.column(c).to_pylist() for c in ("w", "items", "postings")))))
    head = np.frombuffer(rows.pop("")[2], "<i8").reshape(2, -1)
    lengths, which = np.unique(head[1], return_inverse=True)
    m = np.array([LENGTH_SCALE * (100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * n_docs // max(all_terms, 1)) for x in lengths], np.int64)[which]
    of: dict = {}
    for w, items, postings in rows.values():
        values = unpacked(postings)
        documents, tf = np.cumsum(values[::2]) - 1, values[1::2]
        scores = w * (SCALE * tf // (TF_SCALE * tf + m[documents]))
        if w > 0:
            entry = (int(scores.max()), documents.tolist(), scores.tolist())
            for item in items:
                of.setdefault(item["item_id"], []).append(entry)
    out: tuple[list, list[int], list[int]] = ([], [], [])
    for item, lists in of.items():
        for score, document in merge(lists, k):
            out[0].append(item)
            out[1].append(int(head[0, document]))
            out[2].append(score)
    return out


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and its different terms, of items (item_id, text)."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", 4 << 20):
            found = [sorted(set(terms(x))) for x in batch.column("text").cast(pa.binary()).to_pylist()]
            which = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(which)), pa.array([t for x in found for t in x], pa.binary()).cast(pa.string())], names=["item_id", "term"])

    return items.select(items["item_id"].alias("item_id"), items["text"].alias("text")).mapInArrow(run, f"item_id {kind}, term string").distinct()


def search(postings: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each of items (item_id, text). postings: a table as index() gives it."""
    kind = items.schema["item_id"].dataType.simpleString()
    with common.scratch(postings.sparkSession):
        wanted = common.cut(item_terms(items), "terms")
        blocks = -(-wanted.select("item_id").distinct().count() // ITEMS)
        asked = wanted.select("term").distinct()
        found = common.cut(postings.join(common.small(asked), "term", "left_semi"), "postings")
        heads = common.cut(postings.where("term = ''"), "heads")
        n_docs, all_terms = heads.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
        weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * F.sum("df") + 1))).cast("bigint")
        block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1))).cast("int")
        lists = wanted.groupBy(block.alias("block"), "term").agg(F.collect_list(F.struct("item_id")).alias("items"))
        weighed = lists.join(found.groupBy("term").agg(weight.alias("w")), "term")
        rows = found.select("shard", "term", "postings").join(common.small(weighed, common.LOOKUP_ROWS // 10), "term")
        heads = heads.select("shard", "term", "postings", F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))).alias("block"))
        rows = rows.unionByName(heads, allowMissingColumns=True)

        def run(table: pa.Table) -> pa.Table:
            names, documents, scores = shard_best(table, n_docs, all_terms, k)
            common.give_back()
            return pa.table({"item_id": pa.array(names, table.schema.field("items").type.value_type.field("item_id").type), "doc_id": pa.array(documents, pa.int64()), "score": pa.array(scores, pa.int64())})

        best = rows.groupBy("shard", "block").applyInArrow(run, f"item_id {kind}, doc_id bigint, score bigint")
        rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
        best = best.withColumn("rank", rank).where(F.col("rank") <= k)
        doc_id = F.when(F.col("doc_id") != common.NULL_ID, F.col("doc_id"))
        return common.cut(best.select("item_id", "rank", doc_id.alias("doc_id"), "score"), "ranks", keep=True)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """search() of items in the index of docs, which is deleted afterwards."""
    with common.scratch(docs.sparkSession):
        out = search(common.cut(index(docs), "index"), items, k)
        return common.cut(out, "ranked", keep=True)
