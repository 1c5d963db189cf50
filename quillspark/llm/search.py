"""Ranked lexical search: an index of compressed postings in shards, merged document at a time.

A shard is what one task read in a row, up to SHARD_BYTES of text, sorted by doc_id; no text crosses the
network. Of each term it holds one row: gaps of document numbers and counts, as variable-length bytes. A row
without a term holds the ids and lengths of the shard's documents.

A query is answered per shard by a heap over its terms' postings that gives documents in order. The best
k so far are a heap of (score, doc_id). Once terms at the lower end cannot lift a document above the
worst of these, even together, they leave the merge and are only looked up for documents that others
bring. So each shard gives its k best, and these are ranked over all shards.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, tidied

#: A term is a maximal run of characters other than these ASCII ones; of UTF-8, bytes can be taken for characters.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Text of a shard; text that is split at once; terms that are counted at once.
SHARD_BYTES, SLICE_BYTES, COUNT_AT_ONCE = 24 << 20, 4 << 20, 1 << 20
#: Rows (item, term) of queries that are answered at once; about 10 MB.
QUERY_ROWS = 200_000
#: Fixed values of the ranking: scale of weights and scores, and how a document's length counts.
W_SCALE, UNIT, SATURATION, FIXED, BY_LENGTH = 1000, 1_000_000_000, 8, 10, 90
INDEX = "shard long, term binary, n long, total long, data binary"


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes taken by each) of unsigned numbers, seven bits a byte, the lowest first; the last byte has no high bit."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), dtype=np.int64)
    for k in range(1, 10):
        size += values >= np.uint64(1 << 7 * k)
    start = np.cumsum(size) - size
    out = np.empty(int(size.sum()), dtype=np.uint8)
    at = np.arange(len(values))
    k = 0
    while len(at):
        more = size[at] > k + 1
        out[start[at] + k] = (values[at] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8) | (more.astype(np.uint8) << 7)
        at = at[more]
        k += 1
    return out, size


def unpacked(data: bytes) -> np.ndarray:
    """The numbers of packed()."""
    raw = np.frombuffer(data, dtype=np.uint8)
    last = np.flatnonzero(raw < 128)
    start = np.r_[0, last[:-1] + 1] if len(last) else last
    out = np.zeros(len(last), dtype=np.uint64)
    size = last - start + 1
    at, k = np.arange(len(last)), 0
    while len(at):
        out[at] |= (raw[start[at] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
        k += 1
        at = at[size[at] > k]
    return out


class _Ids(dict):
    """Numbers of terms, given as they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def _slices(body: bytes) -> Iterator[bytes]:
    """body in slices that end between terms, but for one that is a single term."""
    start = 0
    while start < len(body):
        end = start + SLICE_BYTES
        if end < len(body):
            cut = next((m.start() for m in re.finditer(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", body[end : end + SLICE_BYTES])), None)
            end = end + cut if cut is not None else len(body)
        yield body[start:end]
        start = end


class _Shard:
    """Documents that wait to be written as one shard."""

    find = re.compile(TERM.encode()).findall
    lower = bytes.maketrans(UPPER.encode(), LOWER.encode())

    def __init__(self) -> None:
        self.terms, self.ids, self.size = _Ids(), [], 0
        self.pending: list[np.ndarray] = []
        self.n_pending = 0
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc_id: int | None, body: bytes) -> None:
        doc = len(self.ids)
        self.ids.append(doc_id)
        self.size += len(body)
        for part in _slices(body.translate(self.lower)):
            found = self.find(part)
            self.pending.append(np.fromiter(map(self.terms.__getitem__, found), dtype=np.int64, count=len(found)) << 32 | doc)
            self.n_pending += len(found)
            if self.n_pending >= COUNT_AT_ONCE:
                self._count()

    def _count(self) -> None:
        if self.n_pending:
            key, n = np.unique(np.concatenate(self.pending), return_counts=True)
            self.keys.append(key)
            self.counts.append(n)
            self.pending, self.n_pending = [], 0

    def rows(self, shard: int) -> pa.RecordBatch:
        self._count()
        # Documents and terms are numbered anew, in the order of their ids and bytes.
        n_docs = len(self.ids)
        null = np.array([i is None for i in self.ids], dtype=bool)
        ids = np.array([i or 0 for i in self.ids], dtype=np.int64)
        order = np.lexsort((ids, null))
        rank = np.empty(n_docs, dtype=np.int64)
        rank[order] = np.arange(n_docs)
        names = sorted(self.terms)
        place = np.empty(len(names), dtype=np.int64)
        place[np.fromiter(map(self.terms.__getitem__, names), dtype=np.int64, count=len(names))] = np.arange(len(names))
        key = np.concatenate([*self.keys, np.empty(0, dtype=np.int64)])
        count = np.concatenate([*self.counts, np.empty(0, dtype=np.int64)])
        key = place[key >> 32] * n_docs + rank[key & 0xFFFFFFFF]
        by = np.argsort(key, kind="stable")
        key, count = key[by], count[by]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, dtype=np.int64)
        key, count = key[first], np.add.reduceat(count, first) if len(first) else count
        term, doc = key // n_docs, key % n_docs
        lengths = np.bincount(doc, weights=count, minlength=n_docs).astype(np.int64)
        start = np.searchsorted(term, np.arange(len(names)))
        gap = np.diff(doc, prepend=-1)
        gap[start] = doc[start] + 1
        data, size = packed(np.stack([gap, count], axis=1).reshape(-1))
        end = np.cumsum(size)[1::2] if len(key) else np.empty(0, dtype=np.int64)
        last = np.r_[start[1:], len(key)] - 1
        offsets = np.r_[0, end[last]] if len(names) else np.zeros(1, dtype=np.int64)
        blobs = pa.BinaryArray.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
        totals = np.add.reduceat(count, start) if len(names) else np.empty(0, dtype=np.int64)
        ids = ids[order].view(np.uint64)
        about, _ = packed(np.r_[np.uint64(n_docs), np.uint64(null.sum()), np.diff(ids, prepend=np.uint64(0)), lengths.astype(np.uint64)])
        heads = [pa.array([shard], pa.int64()), pa.array([None], pa.binary()), pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()), pa.array([about.tobytes()], pa.binary())]
        body = [pa.array(np.full(len(names), shard)), pa.array(names, pa.binary()), pa.array(last - start + 1), pa.array(totals), blobs]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([h, b]) for h, b in zip(heads, body)], names=["shard", "term", "n", "total", "data"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, k, held = TaskContext.get().partitionId() << 32, 0, _Shard()
    for batch in batches:
        for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
            held.add(doc_id, body.as_py())
            if held.size >= SHARD_BYTES:
                yield held.rows(base + k)
                held, k = _Shard(), k + 1
    if held.ids:
        yield held.rows(base + k)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of docs: shard, term (null: the shard's documents), n (documents), total (occurrences), data. Write it before use.

    Terms are runs of letters, digits and whatever is not ASCII, A-Z lower-cased. Null texts have none. Rows that
    repeat are documents of their own; null ids sort last. Texts are read whole, of any length, in
    slices. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    return rows.mapInArrow(tidied(_shards), INDEX)


def best(lists: list[tuple[int, list[int], list[int]]], k: int) -> list[tuple[int, int]]:
    """(score, document) of the k best by the sum of their scores in lists of (bound of the scores, documents in order, scores), in no order.

    Documents with a sum of 0 are left out; of equal ones the first stay.
    """
    lists = sorted(lists, key=lambda x: x[0])
    reach, total = [], 0
    for bound, _, _ in lists:
        total += bound
        reach.append(total)
    docs, scores = [x[1] for x in lists], [x[2] for x in lists]
    place = [0] * len(lists)
    # Lists before `driving` cannot lift a document into the result by themselves.
    least = driving = 0
    while driving < len(lists) and reach[driving] <= least:
        driving += 1
    heap = [(d[0], i) for i, d in enumerate(docs) if i >= driving and d]
    heapq.heapify(heap)
    top: list[tuple[int, int]] = []
    while heap:
        doc, score = heap[0][0], 0
        while heap and heap[0][0] == doc:
            i = heap[0][1]
            if i < driving:
                heapq.heappop(heap)
                continue
            p = place[i]
            score += scores[i][p]
            place[i] = p = p + 1
            if p < len(docs[i]):
                heapq.heapreplace(heap, (docs[i][p], i))
            else:
                heapq.heappop(heap)
        for i in range(driving - 1, -1, -1):
            if score + reach[i] <= least:
                break
            place[i] = p = bisect_left(docs[i], doc, place[i])
            if p < len(docs[i]) and docs[i][p] == doc:
                score += scores[i][p]
        if score > least:
            if len(top) < k:
                heapq.heappush(top, (score, -doc))
            else:
                heapq.heapreplace(top, (score, -doc))
            if len(top) == k and top[0][0] > least:
                least = top[0][0]
                while driving < len(lists) and reach[driving] <= least:
                    driving += 1
    return [(score, -doc) for score, doc in top]


def _postings(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    cells = unpacked(data).astype(np.int64)
    return np.cumsum(cells[::2]) - 1, cells[1::2]


def _search(queries, n_docs: int, n_terms: int, k: int):
    """The k best of each query among the documents of a shard."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        is_term = frame["term"].notna()
        about = unpacked(frame.loc[~is_term, "data"].iloc[0])
        n, null = int(about[0]), int(about[1])
        ids = np.cumsum(about[2 : 2 + n]).view(np.int64)
        lengths = about[2 + n :].astype(np.int64)
        slow = SATURATION * (FIXED + BY_LENGTH * lengths * n_docs // max(n_terms, 1))
        lists: dict[bytes, tuple[int, list[int], list[int]]] = {}
        weights, items = queries.value
        for term, data in zip(frame.loc[is_term, "term"], frame.loc[is_term, "data"]):
            doc, tf = _postings(data)
            score = weights[bytes(term)] * (UNIT * tf // (W_SCALE * tf + slow[doc]))
            lists[bytes(term)] = (int(score.max()), doc.tolist(), score.tolist())
        out: list[tuple] = []
        for item, terms in items:
            some = [lists[t] for t in terms if t in lists]
            if some:
                out += [(item, None if doc >= n - null else int(ids[doc]), score) for score, doc in best(some, k)]
        columns = list(zip(*out)) or [(), (), ()]
        return pd.DataFrame({"item_id": pd.array(columns[0], dtype="Int64"), "doc_id": pd.array(columns[1], dtype="Int64"), "score": np.array(columns[2], dtype=np.int64)})

    return run


def search(index: DataFrame, items: DataFrame, scratch: Scratch, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of a written index for each item, ranks from 1.

    Equal scores go by doc_id, null last. Rows of one item_id (null too) are one query with the terms of all;
    items without a term that the index holds have no rows. Queries go in blocks of about QUERY_ROWS
    rows (item, term), each block to all shards; only that much of the queries comes to the driver.
    """
    spark = index.sparkSession
    term = F.explode(F.regexp_extract_all(F.translate(F.col(text_col).cast("string"), UPPER, LOWER), F.lit(TERM), F.lit(0)))
    wanted = scratch.write(items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col)).select("item_id", term.alias("term")).select("item_id", F.col("term").cast("binary").alias("term")).distinct(), "wanted")
    sums = index.filter("term is null").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    n_docs, n_terms = sums.n or 0, sums.total or 0
    terms = index.filter("term is not null")
    frequency = terms.select("term", "n").join(wanted.select("term").distinct(), "term").groupBy("term").agg(F.sum("n").alias("df"))
    blocks = -(-max(wanted.count(), 1) // QUERY_ROWS)
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    known = scratch.write(wanted.join(frequency, "term").withColumn("block", block), "known")
    found = None
    for b in range(blocks):
        rows = known.filter(F.col("block") == b).select("item_id", "term", "df").collect()  # about QUERY_ROWS
        weights = {bytes(r.term): math.floor(W_SCALE * math.log((2 * n_docs + 2) / (2 * r.df + 1))) for r in rows}
        of: dict[int | None, list[bytes]] = {}
        for r in rows:
            of.setdefault(r.item_id, []).append(bytes(r.term))
        queries = spark.sparkContext.broadcast((weights, list(of.items())))
        here = terms.join(known.filter(F.col("block") == b).select("term").distinct(), "term", "left_semi")
        some = index.filter("term is null").unionByName(here).groupBy("shard").applyInPandas(_search(queries, n_docs, n_terms, k), "item_id long, doc_id long, score long")
        found = some if found is None else found.unionByName(some)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """search() of items over an index of docs that is built for it."""
    scratch = Scratch(docs.sparkSession, "search")
    index = scratch.write(build_index(docs), "index")
    out = scratch.write(search(index, items, scratch, k), "ranked")
    scratch.drop("index")
    return out
