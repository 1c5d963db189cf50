"""Removal of byte strings that occur more than once: a suffix order compared by prefix hashes.

Every 400-byte window holds an anchor, the start of its 64-byte gram with the least hash (the
leftmost of equals), so equal windows agree on it and only the suffixes at anchors, about one in 170,
need to be brought together. Windows at the edges of repeats are suffix-sorted by mergesort, where a
comparison finds the common extension by binary search over prefix polynomial hashes; what the hashes
call equal is compared byte by byte. Stretches around anchors that are equal in whole are settled by
their digests before, without a look at their bytes, and so are the windows of anchors with more than
repeats.HOT different contexts. See repeats.py for the dealing out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, tidied
from .repeats import HOT, contexts, covered, repeated_windows, runs_of, text_classes
from .rolling import BYTE_VALUES, Prefixes, mix, sliding_min

U = np.uint64
PLACE = U((1 << 24) - 1)


class ByteWindows:
    """Bytes as symbols; anchors are minimizers."""

    gap, hot = b"", HOT
    #: Symbols of a long text that are looked at together; windows do not care where it is parted.
    slice = 1 << 20

    def __init__(self, width: int = 400, gram: int = 64):
        self.width, self.gram, self.least_bytes = width, gram, width

    def windows(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        start = np.arange(len(piece) - self.width + 1)
        none = np.zeros(len(start), dtype=np.int64)
        return contexts(piece, start, start + self.width, none, none)

    def pieces(self, body: bytes, start: np.ndarray, size: np.ndarray) -> list[bytes]:
        return [body[i : i + n] for i, n in zip(start.tolist(), size.tolist())]

    def symbols(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, dtype=np.uint8)

    def values(self, symbols: np.ndarray) -> np.ndarray:
        return BYTE_VALUES[symbols]

    def anchors(self, bodies: list[bytes]) -> Iterator[dict[str, np.ndarray]]:
        pieces: list[tuple[int, int, bytes]] = []
        size = 0
        for doc, body in enumerate(bodies):
            for start in range(0, max(1, len(body) - self.width + 1), self.slice):
                piece = body[start : start + self.slice + self.width - 1]
                pieces.append((doc, start, piece))
                size += len(piece)
                if size >= self.slice:
                    yield self._of(pieces)
                    pieces, size = [], 0
        if pieces:
            yield self._of(pieces)

    def _of(self, pieces: list[tuple[int, int, bytes]]) -> dict[str, np.ndarray]:
        w, k = self.width, self.gram
        body = b"".join(p for _, _, p in pieces)
        data = np.frombuffer(body, dtype=np.uint8)
        ends = np.cumsum([len(p) for _, _, p in pieces])
        starts = np.r_[0, ends[:-1]]
        none = {c: np.empty(0, dtype=np.int64) for c in ("doc", "a", "lo", "hi")} | {c: np.empty(0, dtype=np.uint64) for c in ("h", "ctx", "ctx2")}
        if len(data) < w:
            return none
        values = BYTE_VALUES[data]
        sums = Prefixes(values)
        at = np.arange(len(data) - k + 1)
        grams = mix(sums.of(at, at + k))
        least = sliding_min((grams & ~PLACE) | at.astype(np.uint64), w - k + 1)
        anchor = (least & PLACE).astype(np.int64)
        # Windows that lie within one piece.
        room = np.zeros(len(data) + 1, dtype=np.int32)
        long = ends - starts >= w
        np.add.at(room, starts[long], 1)
        np.add.at(room, ends[long] - w + 1, -1)
        window = np.flatnonzero(np.cumsum(room)[: len(anchor)] > 0)
        if not len(window):
            return none
        a = anchor[window]
        doc = np.searchsorted(ends, window, side="right")
        new = np.r_[True, (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])]
        first = np.flatnonzero(new)
        p1, p2 = window[first], window[np.r_[first[1:], len(window)] - 1]
        a, doc = a[first], doc[first]
        lo, hi = a - p1, p2 - p1
        ctx, ctx2 = contexts(body, p1, p2 + w, lo, hi)
        shift = np.array([s for _, s, _ in pieces]) - starts
        return {"doc": np.array([d for d, _, _ in pieces])[doc], "a": a + shift[doc], "lo": lo, "hi": hi, "h": grams[a], "ctx": ctx, "ctx2": ctx2}


def _finish(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cls, copies, body, n, data in zip(*(batch.column(c) for c in ("cls", "copies", "body", "n", "data"))):
                text = body.as_py()
                if copies.as_py() > 1:
                    spans = [(0, len(text))] if len(text) >= width else []
                else:
                    spans = covered(*runs_of(n.as_py(), data.as_py()), width)
                digest, at = hashlib.sha256(), 0
                for i, j in spans:
                    digest.update(text[at:i])
                    at = j
                digest.update(text[at:])
                rows.append((cls.as_py(), len(text), sum(j - i for i, j in spans), len(spans), digest.hexdigest(), np.array(spans, dtype="<i4").tobytes()))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["cls", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def _removed(docs: DataFrame, width: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id and class of each row, what becomes of each class)."""
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    members, reps = text_classes(docs, scratch, id_col, text_col)
    found = repeated_windows(reps, ByteWindows(width), scratch)
    out = "cls binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans binary"
    done = reps.join(found.hint("shuffle_hash"), "cls", "left").select("cls", "copies", "body", "n", "data").mapInArrow(tidied(_finish(width)), out)
    done = scratch.write(done, "done")
    scratch.drop("settled")
    return members, done


def remove_repeats(docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (pairs of 32-bit start and end offsets) per row.

    Removed is every byte in a string of `width` bytes that also starts anywhere else in the table,
    in the same text too. Null texts are empty; texts shorter than width keep all. Rows that repeat,
    also with one id, are occurrences of their own. Null ids are kept. An empty table gives no rows.
    Other columns are not read.
    """
    members, done = _removed(docs, width, id_col, text_col)
    return members.join(done, "cls").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def without_repeats(docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each text cut to what is kept of it; all columns and rows stay.

    Bytes of a character that is cut through go. A null text stays null.
    """
    _, done = _removed(docs, width, id_col, text_col)
    spans = done.filter("n_removed > 0").select(F.col("cls").alias("_cls"), F.col("spans").alias("_spans"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, data in zip(texts, spans):
            if text is None or data is None:
                out.append(text)
                continue
            raw, kept, at = text.encode(), [], 0
            for i, j in np.frombuffer(data, dtype="<i4").reshape(-1, 2):
                kept.append(raw[at:i])
                at = j
            out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    cls = F.substring(F.unhex(F.sha2(body, 256)), 1, 16)
    rows = docs.select(F.struct("*").alias("_row"), F.col(text_col).cast("string").alias("_text"), cls.alias("_key"))
    joined = rows.join(spans, F.col("_key") == F.col("_cls"), "left")
    return joined.select(F.col("_row").withField(text_col, F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(cut("_text", "_spans"))).alias("_row")).select("_row.*")
