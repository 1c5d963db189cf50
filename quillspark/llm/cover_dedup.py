"""Removal of word passages that occur more than once: anchors at the places of a difference cover.

Windows of 15 words are hashed only where their place modulo 21 is in {0, 1, 4, 14, 16}. Every
difference modulo 21 is one of two members of that set, so whatever the places of two equal passages
of 35 words in their documents, some offset below 21 puts both on the cover: they share an aligned
anchor, five in 21 places instead of all. From anchors, matches extend to the whole windows around
them: equal contexts, and windows of anchors with more than repeats.HOT different contexts, by digests of the
words themselves, all else by comparing words; see repeats.py.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Scratch, tidied
from .repeats import HOT, contexts, covered, repeated_windows, runs_of, text_classes
from .rolling import Prefixes, mix, single_spaced, word_hashes, word_places

#: A perfect difference set: its differences give each residue modulo 21 once.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)


class WordWindows:
    """Words as symbols; anchors are at cover places."""

    gap, hot = b" ", HOT
    #: Bytes of a long text that are looked at together; windows do not care where it is parted.
    slice = 1 << 20
    blank = re.compile(b"[\\x20\\x09-\\x0d]")

    def __init__(self, width: int = 35):
        if width < PERIOD + 4:
            raise ValueError(f"windows of {PERIOD + 4} words at least")
        self.width, self.span = width, width - PERIOD + 1
        #: The words after a slice that its last windows reach into.
        self.more = re.compile(b"(?:[\\x20\\x09-\\x0d]+[^\\x20\\x09-\\x0d]+){0,%d}" % (width - 1))
        #: A text of fewer bytes has fewer words.
        self.least_bytes = 2 * width - 1

    def windows(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        start, end = word_places(piece)
        n = len(start) - self.width + 1
        none = np.zeros(n, dtype=np.int64)
        return contexts(piece, start[:n], end[self.width - 1 :], none, none)

    def pieces(self, body: bytes, start: np.ndarray, size: np.ndarray) -> list[bytes]:
        text = body.split()
        return [b" ".join(text[i : i + n]) for i, n in zip(start.tolist(), size.tolist())]

    def symbols(self, packed: bytes) -> np.ndarray:
        """Numbers of words, in the order they are seen: exact, whatever their hashes."""
        numbers: dict[bytes, int] = {}
        text = packed.split()
        return np.fromiter((numbers.setdefault(w, len(numbers)) for w in text), np.uint64, len(text))

    def values(self, symbols: np.ndarray) -> np.ndarray:
        return mix(symbols + np.uint64(1))

    def slices(self, body: bytes) -> Iterator[tuple[int, bytes]]:
        """(words before it, slice) of a text: windows that start in a slice end in it, and covers count from its start."""
        start = before = 0
        while start < len(body):
            end = self.blank.search(body, min(len(body), start + self.slice))
            end = end.start() if end else len(body)
            yield before, body[start : self.more.match(body, end).end()]
            before += len(word_places(body[start:end])[0])
            start = end

    def anchors(self, bodies: list[bytes]) -> Iterator[dict[str, np.ndarray]]:
        pieces: list[tuple[int, int, bytes]] = []
        size = 0
        for doc, body in enumerate(bodies):
            for before, piece in self.slices(body):
                pieces.append((doc, before, piece))
                size += len(piece)
                if size >= self.slice:
                    yield self._of(pieces)
                    pieces, size = [], 0
        if pieces:
            yield self._of(pieces)

    def _of(self, pieces: list[tuple[int, int, bytes]]) -> dict[str, np.ndarray]:
        sizes = np.array([len(p) + 1 for _, _, p in pieces])
        body = b"\n".join([p for _, _, p in pieces])
        counts = np.diff(np.r_[0, np.searchsorted(word_places(body)[0], np.cumsum(sizes))])
        body, starts, ends = single_spaced(body)
        symbols = word_hashes(body, starts, ends)
        base = np.cumsum(counts) - counts
        # Cover places of each piece whose window of words ends within it.
        long = np.flatnonzero(counts >= self.width)
        n = counts[long] - self.span + 1
        periods = -(-n // PERIOD)
        doc = np.repeat(np.arange(len(long)), periods)
        period = np.arange(periods.sum()) - np.repeat(np.cumsum(periods) - periods, periods)
        a = (period[:, None] * PERIOD + np.array(COVER)).reshape(-1)
        doc = np.repeat(doc, len(COVER))
        good = a < n[doc]
        a, doc = a[good], long[doc[good]]
        p1 = np.maximum(0, a - (PERIOD - 1))
        p2 = np.minimum(a, counts[doc] - self.width)
        at = base[doc]
        h = mix(Prefixes(symbols).of(at + a, at + a + self.span)) if len(a) else np.empty(0, dtype=np.uint64)
        lo, hi = a - p1, p2 - p1
        ctx, ctx2 = contexts(body, starts[at + p1], ends[at + p2 + self.width - 1], lo, hi) if len(a) else (h, h)
        before = np.array([b for _, b, _ in pieces])
        return {"doc": np.array([d for d, _, _ in pieces])[doc], "a": a + before[doc], "lo": lo, "hi": hi, "h": h, "ctx": ctx, "ctx2": ctx2}


def _finish(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cls, copies, body, n, data in zip(*(batch.column(c) for c in ("cls", "copies", "body", "n", "data"))):
                # bytes.split() parts at the same six blanks.
                text = body.as_py().split()
                if copies.as_py() > 1:
                    spans = [(0, len(text))] if len(text) >= width else []
                else:
                    spans = covered(*runs_of(n.as_py(), data.as_py()), width)
                kept, at = [], 0
                for i, j in spans:
                    kept += text[at:i]
                    at = j
                kept += text[at:]
                rows.append((cls.as_py(), len(text), sum(j - i for i, j in spans), hashlib.sha256(b" ".join(kept)).hexdigest(), np.array(spans, dtype="<i4").tobytes()))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["cls", "n_words", "n_removed", "kept_sha256", "spans"])

    return run


def remove_passages(docs: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans (pairs of 32-bit word offsets) per row.

    Removed is every word in a window of `width` words whose sequence also starts anywhere else in
    the table, in the same text too. Null texts have no words; texts of fewer words keep all. Rows
    that repeat, also with one id, are occurrences of their own. Null ids are kept. An empty table
    gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "cover-dedup")
    members, reps = text_classes(docs, scratch, id_col, text_col)
    found = repeated_windows(reps, WordWindows(width), scratch)
    out = "cls binary, n_words bigint, n_removed bigint, kept_sha256 string, spans binary"
    done = reps.join(found.hint("shuffle_hash"), "cls", "left").select("cls", "copies", "body", "n", "data").mapInArrow(tidied(_finish(width)), out)
    done = scratch.write(done, "done")
    scratch.drop("settled")
    return members.join(done, "cls").select("doc_id", "n_words", "n_removed", "kept_sha256", "spans")
