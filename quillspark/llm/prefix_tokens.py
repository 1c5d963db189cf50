"""Exact token counts at every prefix of a text, for a byte-level BPE vocabulary.

Method: prefix dynamic programming. A sequence of BPE tokens is the encoding of its bytes if and
only if each two neighbours are the encoding of their joined bytes. So for every prefix of a
pre-token there is one token that ends it and fits the last token of what is before; the count at
the prefix is the count before that token plus one. Counts at all prefixes of each pre-token, and
running sums over pre-tokens, give the count at any prefix of the text.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What Unicode calls white space, the GPT-2 pre-token pattern, its contractions, and
# the printable stand-ins for bytes in byte-level vocabularies.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+".replace("\\s", BLANK))
CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))
CHUNK = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Entries kept in each worker's memo of chunks; it is emptied when full, so memory is bounded.
MEMO = 800_000


def _byte_names() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixCounter:
    """Counts for one tokenizer file; holds memos of what it has seen."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        names = _byte_names()
        raw = lambda s: bytes(map(names.__getitem__, s))
        model = spec["model"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        self.vocab = {raw(t) for t in model["vocab"] if t not in special}
        #: Every ending of a token: what a walk back from a position can go through.
        self.endings = {t[k:] for t in self.vocab for k in range(len(t))}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.special_names = list(special)
        self.split = {a + b: (a, b) for a, b in reversed(self.rank)}
        self.spines: tuple[dict, dict] = ({}, {})
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.own: dict[bytes, bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self.totals = _Totals(self)

    def _spine(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """The pieces that stand at one end of token while it is merged, each with the rank of the merge that ends it."""
        known = self.spines[right]
        if (out := known.get(token)) is None:
            out, until, piece = [], 1 << 60, token
            while True:
                out.append((piece, until))
                if len(piece) == 1:
                    break
                pair = self.split[piece]
                until, piece = self.rank[pair], pair[right]
            known[token] = out
        return out

    def _is_own(self, token: bytes) -> bool:
        """Whether token is what its own bytes encode to: its halves are, and nothing merges across their seam before them."""
        if (known := self.own.get(token)) is None:
            if len(token) == 1:
                known = True
            else:
                pair = self.split[token]
                known = self._is_own(pair[0]) and self._is_own(pair[1]) and self._seam(*pair, self.rank[pair])
            self.own[token] = known
        return known

    def _seam(self, a: bytes, b: bytes, before: int) -> bool:
        """Whether no merge of rank below before joins the end of a to the start of b while both are merged.

        Of two places where the same rule applies, the left one goes first.
        """
        rank, right = self.rank, self._spine(b, False)
        for x, x_until in self._spine(a, True):
            for y, y_until in right:
                r = rank.get((x, y))
                if r is not None and r < before and r < x_until and r <= y_until:
                    return False
        return True

    def _fit(self, a: bytes, b: bytes) -> bool:
        if len(self.fits) >= MEMO:
            self.fits.clear()
        known = self.fits[a, b] = self._is_own(b) and self._seam(a, b, 1 << 60)
        return known

    def piece(self, data: bytes) -> list[int]:
        """Token counts at byte prefixes 0..n of one pre-token."""
        vocab, endings, fits = self.vocab, self.endings, self.fits
        # One token fits at each prefix, so the order of trial is free: what grew by a byte goes first.
        counts, last, token = [0], [b""], b""
        for end in range(1, len(data) + 1):
            start, token = end - 1 - len(token), token + data[end - 1 : end]
            if token in vocab and self._is_own(token) if not start else token in vocab and (fits[pair] if (pair := (last[start], token)) in fits else self._fit(*pair)):
                counts.append(counts[start] + 1)
                last.append(token)
                continue
            start = end
            while start > 0:
                start -= 1
                token = data[start:end]
                if token in vocab:
                    if start:
                        if fits[pair] if (pair := (last[start], token)) in fits else self._fit(*pair):
                            break
                    elif self._is_own(token):
                        break
                elif token not in endings:
                    raise ValueError(f"byte {data[end - 1]} has no token")
            counts.append(counts[start] + 1)
            last.append(token)
        return counts

    def _chars(self, piece: str) -> list[int]:
        """Token counts at character prefixes 1..n of one pre-token."""
        if (known := self.pieces.get(piece)) is not None:
            return known
        data = piece.encode()
        counts = self.piece(data)
        out = counts[1:] if len(data) == len(piece) else [counts[e] for e in accumulate(len(c.encode()) for c in piece)]
        if len(self.pieces) >= MEMO:
            self.pieces.clear()
        if len(piece) <= 64:
            self.pieces[piece] = out
        return out

    def table(self, chunk: str) -> list[int]:
        """Token counts at character prefixes 1..n of a chunk: a run of blanks, or of others with at most one space before."""
        if _blank(chunk):
            out = self._chars(chunk)
        else:
            out, base = [], 0
            for piece in PRETOKEN.findall(chunk):
                if piece in CONTRACTIONS:
                    # A cut contraction is an apostrophe and letters, two pre-tokens.
                    own = [1] + [1 + self._chars(piece[1:k])[-1] for k in range(2, len(piece))] + self._chars(piece)[-1:]
                else:
                    own = self._chars(piece)
                out += [base + x for x in own]
                base = out[-1]
        return out

    def _segments(self, text: str) -> list[str]:
        """Text between special strings, and these."""
        if self.specials is None or not any(s in text for s in self.special_names):
            return [text]
        return [s for s in self.specials.split(text) if s]

    def total(self, text: str) -> int:
        known, n = self.totals, 0
        for seg in self._segments(text):
            n += 1 if seg in self.special_names else sum(map(known.__getitem__, CHUNK.findall(seg)))
        return n

    def at_prefixes(self, text: str) -> list[int]:
        """Counts at character prefixes 1..n: those that encoding each prefix by itself would give."""
        out, base, plain, start = [], 0, "", 0
        for seg in self._segments(text):
            if seg in self.special_names:
                # Until it is complete, a special string is plain text that goes on from what is before it.
                out += [start + self._plain(plain + seg[:k]) for k in range(1, len(seg))]
                base += 1
                out.append(base)
                plain, start = "", base
                continue
            chunks = CHUNK.findall(seg)
            for k, chunk in enumerate(chunks):
                out += [base + x for x in self._after(chunks, k)]
                base += self.table(chunk)[-1]
            plain = seg
        return out

    def _plain(self, seg: str) -> int:
        return sum(self.table(c)[-1] for c in CHUNK.findall(seg))

    def _after(self, chunks: list[str], k: int) -> list[int]:
        """The table of chunk k. A prefix that ends a run of blanks has the run as one pre-token, though its last blank belongs to chunk k."""
        own, chunk = self.table(chunks[k]), chunks[k]
        if k and _blank(chunks[k - 1]) and _blank(chunk[0]):
            run = self.table(chunks[k - 1])[-1]
            own = [self.table(chunks[k - 1] + chunk[0])[-1] - run, *own[1:]]
        return own

    def cut(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of at most limit tokens."""
        segs = self._segments(text)
        if len(segs) > 1 or segs and segs[0] in self.special_names:
            counts = self.at_prefixes(text)
            return max((p + 1 for p, c in enumerate(counts) if c <= limit), default=0)
        chunks = CHUNK.findall(text)
        ends = list(accumulate(map(self.totals.__getitem__, chunks)))
        k = bisect_right(ends, limit)
        done = sum(map(len, chunks[:k]))
        if k == len(chunks):
            return done
        base = ends[k - 1] if k else 0
        return done + max((p + 1 for p, c in enumerate(self._after(chunks, k)) if base + c <= limit), default=0)


class _Totals(dict):
    """Tokens of whole chunks; a missing one is worked out from its prefixes."""

    def __init__(self, counter: PrefixCounter):
        self.counter = counter

    def __missing__(self, chunk: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = self.counter.table(chunk)[-1]
        if len(chunk) <= 64:
            self[chunk] = n
        return n


def _blank(chunk: str) -> bool:
    return re.fullmatch(f"[{BLANK}]+", chunk) is not None


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    """One per worker process and file."""
    return PrefixCounter(path)


def _batches(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[pa.RecordBatch]:
    known = counter(path)
    for batch in batches:
        sizes, totals, cuts = [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            n = known.total(text)
            sizes.append(len(text) if text.isascii() else len(text.encode()))
            totals.append(n)
            cuts.append(len(text) if n <= limit else known.cut(text, limit))
        over = [n > limit for n in totals]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array(over, pa.bool_()), pa.array(cuts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"])


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and cut_chars (characters of the longest prefix of at most limit tokens) per row.

    A map over partitions: no shuffle, and each worker holds a memo of bounded size. Other columns
    are not read. A null text counts as empty: no bytes, no tokens. A null id stays null; rows that
    repeat are counted each. An empty table gives an empty one. Texts are read whole, of any length.
    """
    out = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_chars bigint"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _batches(batches, path, limit), out)


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and prefix_tokens: an array whose entry p is the exact token count of the first p + 1 characters.

    Stored once, it answers any budget question: the tokens of a cut at p characters are entry p - 1,
    and the longest cut within a budget is the last entry not above it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                arrays = [known.at_prefixes(v.as_py() or "") for v in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(arrays, pa.list_(pa.int32()))], names=["doc_id", "prefix_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, prefix_tokens array<int>")


def truncated(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text cut to the longest prefix of at most limit tokens. Null texts become empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            texts = [v.as_py() or "" for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t[: known.cut(t, limit)] for t in texts], pa.string())], names=["doc_id", "text"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text string")
