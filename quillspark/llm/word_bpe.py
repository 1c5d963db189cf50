"""Token ids of a lower-casing word BPE, many words at once.

Texts of ASCII and Latin-1 letters are split at blanks and dictionary-encoded, and the distinct chunks
of a batch are split into pre-tokens by one pattern. A pre-token gets a number the first time it is
seen, and its ids are worked out with all others that are new in the batch: in each round, every word
merges its pair of least rank, over arrays. Ids of texts are then gathered by number. Everything else (other characters, special strings, very long
pre-tokens) goes to the library, by blank-separated chunk.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What Unicode calls white space, and the alternatives of the vocabulary's pre-token pattern that are literal.
UNICODE_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: Pre-tokens don't cross white space, so texts can be encoded by chunk.
CHUNK = re.compile(f"[^{UNICODE_BLANK}]+")
#: Characters whose class and lower case are beyond doubt: ASCII, and the letters of Latin-1 with a few signs.
OTHER = re.compile("[^\\t-\\r -~¡£§«»¿À-ÿ]")
#: The end of a text within a batch; no text that is split here has it.
END = "\x00"
PRETOKEN = re.compile(f"{END}|[a-zß-öø-ÿ]+|{CONTRACTIONS}|[0-9]|[^\\s{END}a-zß-öø-ÿ0-9]+")
#: Longer pre-tokens go to the library: rounds over arrays follow the longest word.
LONGEST = 64
NONE = np.int32(1 << 30)


class Merges:
    """The merges of a vocabulary as an open-addressing table from a pair of ids to its rank and result."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        suffix = model["end_of_word_suffix"] or ""
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.uint64) for k in (0, 1))
        self.result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        made = np.full(len(vocab), -1, dtype=np.int64)
        made[self.result] = np.arange(len(pairs))
        # All occurrences of a pair may be merged at once only if a merge's result takes part in later merges alone.
        self.in_order = bool((made[left] < np.arange(len(pairs))).all() and (made[right] < np.arange(len(pairs))).all() and len(set(self.result.tolist())) == len(pairs))
        bits = max(18, len(pairs).bit_length() + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, NONE, dtype=np.int32)
        key = (left << np.uint64(32) | right).view(np.int64)
        todo, self.reach = np.arange(len(pairs)), 0
        slot = self._slot(key)
        while len(todo):
            at = slot[todo]
            free = todo[self.keys[at] == -1]
            self.keys[slot[free]] = key[free]
            self.ranks[slot[free]] = free
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask
            self.reach += 1
        self.ranks[slot] = np.arange(len(pairs))
        signs = _byte_signs()
        self.inner = np.array([vocab.get(s, -1) for s in signs], dtype=np.int32)
        self.last = np.array([vocab.get(s + suffix, -1) for s in signs], dtype=np.int32)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.ranks[slot], NONE)
        on = np.flatnonzero((there != key) & (there != -1))
        for _ in range(self.reach):
            if not len(on):
                break
            slot[on] = (slot[on] + 1) & self.mask
            there = self.keys[slot[on]]
            hit = there == key[on]
            out[on[hit]] = self.ranks[slot[on[hit]]]
            on = on[~hit & (there != -1)]
        return out

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, tokens of each)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = self.inner[data]
        ends = np.cumsum(sizes)
        ids[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_words = [], []
        while len(ids):
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank = np.full(len(ids), NONE, dtype=np.int32)
            rank[inside] = self.rank(ids[inside], ids[inside + 1])
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(ids)])
            over = np.repeat(least == NONE, size)
            if over.any():
                done_ids.append(ids[over])
                done_words.append(word[over])
                ids, word, rank = ids[~over], word[~over], rank[~over]
                least, size = least[least != NONE], size[least != NONE]
                if not len(ids):
                    break
            hit = rank == np.repeat(least, size)
            twice = np.flatnonzero(hit[1:] & hit[:-1])
            if len(twice):
                # A run of one sign: every other pair, from the left.
                at = np.flatnonzero(hit)
                start = np.maximum.accumulate(np.where(np.r_[True, (at[1:] != at[:-1] + 1)], at, 0))
                hit[at[(at - start) % 2 == 1]] = False
            at = np.flatnonzero(hit)
            ids[at] = self.result[rank[at]]
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            ids, word = ids[stay], word[stay]
        if not done_ids:
            return np.empty(0, dtype=np.int32), np.zeros(len(words), dtype=np.int64)
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(words))


def _byte_signs() -> list[str]:
    """The printable sign of each byte in byte-level vocabularies: itself, or the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in signs:
            signs[b] = chr(extra)
            extra += 1
    return [signs[b] for b in range(256)]


def _gathered(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the stretches of values one after the other, where each ends)."""
    ends = np.cumsum(size)
    if not len(ends):
        return values[:0], ends
    return values[np.repeat(start - (ends - size), size) + np.arange(ends[-1])], ends


class _Numbers(dict):
    """Numbers of pre-tokens, in the order they are seen."""

    def __missing__(self, token: str) -> int:
        n = self[token] = len(self)
        return n


class WordEncoder:
    def __init__(self, path: str, memo: int):
        self.path, self.encode_batch = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.merges = Merges(spec["model"])
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = json.dumps((spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern"))
        usual = spec["model"]["continuing_subword_prefix"] is None and not spec["model"]["ignore_merges"] and (self.merges.inner >= 0).all() and (self.merges.last >= 0).all()
        #: Whether the file is of the kind that is encoded here; if not, the library does it all.
        self.known = bool(usual and self.merges.in_order and kinds == ["NFC", "Replace", "Lowercase"] and split == json.dumps({"Regex": PATTERN}) and spec["post_processor"] is None)
        self.memo = memo
        self.clear()

    def clear(self) -> None:
        """Forget the memos."""
        self.chunks: dict[str, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.numbers[END]  # number 0, no ids
        self.ids_of, self.start, self.size = np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def _library(self, text: str) -> np.ndarray:
        if self.encode_batch is None:
            # Loaded when it is first needed: it takes more memory than all else here.
            from tokenizers import Tokenizer

            self.encode_batch = Tokenizer.from_file(self.path).encode_batch_fast
        return np.asarray(self.encode_batch([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _by_chunk(self, text: str) -> np.ndarray:
        out = []
        for chunk in CHUNK.findall(text):
            ids = self.chunks.get(chunk)
            if ids is None:
                ids = self._library(chunk)
                if len(chunk) <= LONGEST:
                    if len(self.chunks) >= self.memo // 4:
                        self.chunks.clear()
                    self.chunks[chunk] = ids
            out.append(ids)
        return np.concatenate(out) if out else np.empty(0, dtype=np.uint32)

    def _learn(self, new: list[str]) -> None:
        short = [w.encode() if len(w) <= LONGEST else b" " for w in new]
        ids, size = self.merges.encode(short)
        parts, sizes, at = [], size, 0
        ends = np.cumsum(size)
        for k in [k for k, w in enumerate(new) if len(w) > LONGEST]:
            parts += [ids[at : ends[k] - size[k]], self._library(new[k])]
            at = ends[k]
            sizes[k] = len(parts[-1])
        ids = np.concatenate([*parts, ids[at:]]).astype(np.uint32)
        self.start = np.r_[self.start, len(self.ids_of) + np.cumsum(sizes) - sizes]
        self.size = np.r_[self.size, sizes]
        self.ids_of = np.r_[self.ids_of, ids]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text, as the library gives them without special tokens added."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for k, text in enumerate(texts):
            if self.known and OTHER.search(text) is None and not any(s in text for s in self.specials):
                plain.append(k)
            else:
                out[k] = self._by_chunk(text)
        if plain:
            if len(self.numbers) > self.memo:
                self._clear()
            chunks = pc.ascii_split_whitespace(pa.array([texts[k] for k in plain], pa.large_string()))
            coded = chunks.flatten().dictionary_encode()
            tokens = PRETOKEN.findall(END.join([*coded.dictionary.to_pylist(), ""]).lower())
            numbers = np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))
            if len(self.numbers) > len(self.size):
                self._learn(list(self.numbers)[len(self.size) :])
            ids, ends = _gathered(self.ids_of, self.start[numbers], self.size[numbers])
            # Ids of the distinct chunks, then of the texts.
            ends = ends[numbers == 0]
            of = coded.indices.to_numpy()
            start = np.r_[0, ends[:-1]]
            ids, ends = _gathered(ids, start[of], (ends - start)[of])
            cut = np.r_[0, ends][chunks.offsets.to_numpy()].tolist()
            for k, i, j in zip(plain, cut, cut[1:]):
                out[k] = ids[i:j]
        return out


@lru_cache(maxsize=2)
def encoder(path: str, memo: int) -> WordEncoder:
    """One per worker process and file."""
    return WordEncoder(path, memo)
