"""Packing token sequences into fixed windows: shortest-pack-first over the length histogram.

Documents are tokenized once, in a map over partitions (see word_bpe.py). Only (id, start, length, checksum) rows go on. Whole windows stand alone; the histogram of
what is left has at most `window` entries whatever the corpus holds, and the plan made from it on the
driver counts packing patterns, not documents. Patterns go back to documents by rank within a
length; ranks come from counts per (length, hash bucket), so a length shared by a third of all rows
is spread over many tasks.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, by_size, tidy
from .word_bpe import WordEncoder, encoder

#: Entries kept in each worker's memos; one is emptied when full.
MEMO = 200_000
#: Bytes of text that are split and encoded at once.
TEXT_BYTES = 2 << 20
#: Rows of a hash bucket that ranks are counted in, about.
BUCKET_ROWS = 2048


def pieces(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece: whole windows and what is left of each document."""
    end = np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path, MEMO)
        try:
            yield from encoded(batches, known)
        finally:
            # The worker may go on with other work.
            known.clear()
            tidy()

    def encoded(batches: Iterator[pa.RecordBatch], known: WordEncoder) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for some in by_size(batch, TEXT_BYTES):
                for key, ids in zip(some.column(0).to_pylist(), known.ids([v or "" for v in some.column(1).to_pylist()])):
                    data = ids.tobytes() + end
                    n = len(data) // 4
                    for start in range(0, n, window):
                        part = data[4 * start : 4 * (start + window)]
                        rows.append((key, start, len(part) // 4, zlib.crc32(part), n, np.frombuffer(part, "<u4") if with_ids else None))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + with_ids]
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(columns[k], kinds[k]) for k in range(len(names))], names=names)

    out = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<bigint>" * with_ids
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, out)


def plan(histogram: dict[int, int], window: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Packing patterns as ([(length, how many of it in a pack), ...], packs), for counts of lengths.

    Lengths go longest first, each into the packs with the most room; packs without room stay
    closed. All packs of a pattern are treated at once, so the work follows the number of patterns.
    """
    # Open patterns by room, most first: (-room, serial, items, packs)
    heap: list[tuple[int, int, list[tuple[int, int]], int]] = []
    serial, done = 0, []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and -heap[0][0] >= length:
                room, _, items, packs = heapq.heappop(heap)
                room = -room
                # How many of this length a pack takes before another pack has more room.
                other = -heap[0][0] if heap else 0
                fit = max(1, min(room // length, (room - other) // length + 1))
                if left >= packs:
                    each = min(fit, left // packs)
                    rest = None
                    used = packs
                else:
                    each, used = 1, left
                    rest = (-room, serial, items, packs - used)
                left -= each * used
            else:
                items, room, rest = [], window, None
                fit = window // length
                # A new pack has the most room until it is full: the open ones have less than this length.
                used, each = (left // fit, fit) if left >= fit else (1, left)
                left -= each * used
            if rest is not None:
                serial += 1
                heapq.heappush(heap, rest)
            serial += 1
            now = room - each * length
            entry = (-now, serial, [*items, (length, each)], used)
            if now:
                heapq.heappush(heap, entry)
            else:
                done.append(entry)
    return [(items, packs) for _, _, items, packs in sorted([*done, *heap], key=lambda e: e[1])]


def slots(patterns: list[tuple[list[tuple[int, int]], int]], first: int) -> np.ndarray:
    """Rank ranges of each length: columns length, rank from, rank to, first sequence, per pack, offset; sorted by length and rank."""
    out, used, sequence = [], {}, first
    for items, packs in patterns:
        offset = 0
        for length, each in items:
            rank = used.get(length, 0)
            out.append((length, rank, rank + each * packs, sequence, each, offset))
            used[length] = rank + each * packs
            offset += each * length
        sequence += packs
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 6)


def pack(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents with sequence_id and offset; every sequence holds at most window ids.

    A null text is an empty one: a piece with the end id alone. A null id stays null. Rows that
    repeat are packed each. An empty table gives no rows. Other columns are not read. Texts are
    tokenized whole; long ones are cut into whole windows and a rest.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    rows = scratch.write(pieces(docs, path, window, end_id, id_col=id_col, text_col=text_col), "pieces")
    # At most `window` rows come to the driver.
    histogram = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    whole = histogram.pop(window, 0)
    table = slots([([(window, 1)], whole)] * bool(whole) + plan(histogram, window), 0)

    n = max(1, (whole + sum(histogram.values())) // BUCKET_ROWS)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n)))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    inner = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        dealt.withColumn("row", F.row_number().over(inner))
        .join(before.select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before")), ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("row") - 1)
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 40 | table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = table[np.searchsorted(keys, length << 40 | rank, side="right") - 1]
            copy, k = np.divmod(rank - at[:, 1], at[:, 4])
            extra = [pa.array(at[:, 3] + copy), pa.array(at[:, 5] + k * length)]
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, *extra], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    out = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(place, out)
