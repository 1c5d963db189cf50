"""Hashes of words, prefix polynomial hashes over symbols, and suffix sorting by comparing them.

Anchors and shingles are hashed by sums of c_i * B^(i - start) modulo 2^64 over random c_i, read off a
running sum by one subtraction and one multiplication with a power of B's inverse, then mixed. Such
sums are quick, but some pairs of long sequences (Thue-Morse words) agree for every base, so nothing
is called equal by them alone. Suffixes are compared by sums modulo the prime 2^61 - 1, for which two
different sequences agree at few bases only.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

U = np.uint64
_RNG = np.random.default_rng(20240607)
#: Random values of bytes, and two bases; the same in every process.
BYTE_VALUES = _RNG.integers(0, 1 << 64, size=256, dtype=np.uint64)
BASES = [int(x) | 1 for x in _RNG.integers(0, 1 << 64, size=2, dtype=np.uint64)]
LENGTH_SALT = U(int(_RNG.integers(0, 1 << 64, dtype=np.uint64)) | 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse."""
    known = _POWERS.get(which)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 17)
        base = BASES[which]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        known = (both[0], both[1])
        if size <= 1 << 20:
            _POWERS[which] = known
    return known


class Prefixes:
    """Prefix hashes of a sequence of 64-bit symbol values."""

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self.down = powers(len(values) + 1, which)
        self.sums = np.empty(len(values) + 1, dtype=np.uint64)
        self.sums[0] = 0
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the stretches [start, end), unmixed."""
        return (self.sums[end] - self.sums[start]) * self.down[start]


#: Lanes of eight bytes of which a word's hash is made; longer words are hashed by BLAKE2b.
LANES = 8
LANE_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of data: runs of bytes that are no ASCII blank."""
    raw = np.frombuffer(data, dtype=np.uint8)
    blank = np.ones(len(raw) + 2, dtype=np.int8)
    blank[1:-1] = SPACE[raw]
    edge = np.diff(blank)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of data: lanes of eight bytes, chained by a mixer that is no polynomial."""
    padded = np.frombuffer(data + bytes(8), dtype=np.uint8)
    lanes = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    size = end - start
    out = mix(size.astype(np.uint64) * LENGTH_SALT)
    at = np.arange(len(start))
    for k in range(LANES):
        at = at[size[at] > 8 * k]
        if not len(at):
            break
        left = np.minimum(size[at] - 8 * k, 8)
        out[at] = mix(out[at] * U(0x9E3779B97F4A7C15) ^ (lanes[start[at] + 8 * k] & LANE_MASKS[left]))
    for k in np.flatnonzero(size > 8 * LANES).tolist():
        out[k] = int.from_bytes(blake2b(data[start[k] : end[k]], digest_size=8).digest(), "little")
    return out


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of data."""
    start, end = word_places(data)
    return start, word_hashes(data, start, end)


def single_spaced(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(the words of data with one space between them, where each starts and ends)."""
    start, end = word_places(data)
    size = end - start
    ends = np.cumsum(size + 1) - 1
    raw = np.frombuffer(data, dtype=np.uint8)
    stay = ~SPACE[raw]
    # The first blank after each word but the last stays, as a space.
    stay[end[:-1]] = True
    out = raw[stay]
    out[ends[:-1]] = 32
    return out.tobytes(), ends - size, ends


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of width values."""
    n = len(x)
    if n < width:
        return np.empty(0, dtype=x.dtype)
    full = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    full[:n] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


#: The prime 2^61 - 1, and a base for sums modulo it.
PRIME = U((1 << 61) - 1)
PRIME_BASE = int(_RNG.integers(1 << 32, (1 << 61) - 2, dtype=np.uint64))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME."""
    x = (x & PRIME) + (x >> U(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, of numbers below it, by halves."""
    low = U((1 << 31) - 1)
    ah, al, bh, bl = a >> U(31), a & low, b >> U(31), b & low
    middle = al * bh + ah * bl
    return _reduced((ah * bh << U(1)) + (middle >> U(30)) + ((middle & U((1 << 30) - 1)) << U(31)) + al * bl)


def prime_powers(n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    step = PRIME_BASE
    while len(out) < n:
        out = np.r_[out, times(out, np.full(len(out), step, dtype=np.uint64))]
        step = step * step % int(PRIME)
    return out[:n]


class PrimePrefixes:
    """Prefix sums of c_i * B^i modulo PRIME, to compare stretches by."""

    def __init__(self, values: np.ndarray):
        self.powers = prime_powers(len(values) + 1)
        terms = times(_reduced(values), self.powers[: len(values)])
        # Running sums of halves, as those of whole terms would overflow.
        low, high = np.cumsum(terms & U((1 << 32) - 1)), np.cumsum(terms >> U(32))
        self.sums = np.r_[U(0), _reduced(_reduced(times(_reduced(high), np.full(len(high), 1 << 32, dtype=np.uint64))) + _reduced(low))]

    def same(self, a: np.ndarray, b: np.ndarray, n) -> np.ndarray:
        """Whether the stretches of n symbols at a and b have one hash."""
        a, b = np.minimum(a, b), np.maximum(a, b)
        x, y = (_reduced(self.sums[p + n] + (PRIME - self.sums[p])) for p in (a, b))
        return times(x, self.powers[b - a]) == y


class SuffixOrder:
    """Suffixes of a sequence, compared over their first `limit` symbols by hashes of common extensions."""

    def __init__(self, symbols: np.ndarray, values: np.ndarray, limit: int):
        self.symbols, self.limit = symbols, limit
        self.hashes = PrimePrefixes(values)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at a and b share, up to limit: binary search over prefix hashes."""
        low = np.zeros(len(a), dtype=np.int64)
        high = np.full(len(a), self.limit, dtype=np.int64)
        while True:
            on = np.flatnonzero(low < high)
            if not len(on):
                return low
            mid = (low[on] + high[on] + 1) // 2
            same = self.hashes.same(a[on], b[on], mid)
            low[on] = np.where(same, mid, low[on])
            high[on] = np.where(same, high[on], mid - 1)

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at a sorts before that at b; for equal ones, or_equal."""
        end = self.limit
        out = or_equal.copy()
        differ = np.flatnonzero(~self.hashes.same(a, b, end))
        if len(differ):
            x, y = a[differ], b[differ]
            n = self.common(x, y)
            # A full-length match here would be a disagreement of the hashes with themselves.
            n = np.minimum(n, end - 1)
            out[differ] = self.symbols[x + n] < self.symbols[y + n]
        return out

    def sort(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Order that sorts suffixes within runs of equal groups (given in order): mergesort, all merges of a level at once."""
        n = len(starts)
        order = np.arange(n)
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if n else np.empty(0, dtype=np.int64)
        size = np.diff(np.r_[first, n])
        base, length = np.repeat(first, size), np.repeat(size, size)
        width = 1
        while n and width < size.max():
            at = np.flatnonzero(length > width)
            own = at - base[at]
            block = own // (2 * width) * (2 * width)
            left = own < block + width
            low = np.where(left, np.minimum(block + width, length[at]), block) + base[at]
            high = np.where(left, np.minimum(block + 2 * width, length[at]), np.minimum(block + width, length[at])) + base[at]
            other = low.copy()
            mine = starts[order[at]]
            while True:
                on = np.flatnonzero(low < high)
                if not len(on):
                    break
                mid = (low[on] + high[on]) // 2
                # Of equal suffixes, those of the left run come first.
                before = self.less(starts[order[mid]], mine[on], ~left[on])
                low[on] = np.where(before, mid + 1, low[on])
                high[on] = np.where(before, high[on], mid)
            passed = low - other
            run = np.where(left, block, block + width)
            place = base[at] + block + (own - run) + passed
            new = order.copy()
            new[place] = order[at]
            order = new
            width *= 2
        return order

    def equal_neighbours(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """For starts in sorted order: whether each equals its next in the same group over limit symbols, the symbols compared."""
        if len(starts) < 2:
            return np.zeros(len(starts), dtype=bool)
        a, b = starts[:-1], starts[1:]
        out = np.zeros(len(starts), dtype=bool)
        maybe = np.flatnonzero((groups[1:] == groups[:-1]) & self.hashes.same(a, b, self.limit))
        span = np.arange(self.limit)
        for k in range(0, len(maybe), 4096):
            part = maybe[k : k + 4096]
            out[part] = (self.symbols[a[part][:, None] + span] == self.symbols[b[part][:, None] + span]).all(axis=1)
        return out
