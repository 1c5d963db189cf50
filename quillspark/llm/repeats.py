"""Repeated stretches across a corpus: anchors, contexts, then a sorted comparison at the edges.

A window is a run of `width` symbols (bytes or words). What is found is every window whose content
also starts anywhere else. Each window holds an anchor at a place that its content, or the cover,
decides, so equal windows share an anchor at the same place in them:

1. Equal texts become one class with a count; only one of each goes on.
2. Per anchor go its hash, the stretch of windows that hold it, and 96 bits of the BLAKE2b digest of that
   stretch (its context) to the bucket of the anchor's hash. Different contexts with one digest can
   neither be met by chance nor be made. Within a map task, equal contexts are brought to one
   record first, so an anchor shared by a third of the corpus sends one record a task and context.
3. In the bucket, anchors with equal contexts repeat with all their windows. Where one anchor has
   several contexts, one stretch of each is asked for.
4. Those stretches, cut from the texts, meet in the bucket of the anchor's hash. Windows at the same
   place relative to the anchor are suffix-sorted, and neighbours are compared symbol by symbol. Of an
   anchor with very many contexts, windows go by their own digests instead, to as many buckets as
   there are different windows, those of a task that are equal as one record.
5. Per class, the repeated windows are united.

Between steps go binary blocks of packed columns, a few per task and bucket, not rows per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, parts_for, tidied
from .rolling import LENGTH_SALT, SuffixOrder, mix

FULL, ASK, CELL, PIECES = 1, 2, 0, 3
#: Anchors that a task collects before it sends them on; windows that are sorted at once.
FLUSH, SORT_AT_ONCE = 500_000, 250_000
#: Different contexts of an anchor beyond which their windows are not sorted in one task but dealt out by digest.
HOT = 500
BLOCKS = "part int, kind int, n int, data binary"

KINDS = {
    CELL: (("num", "<i8"), ("a", "<i4"), ("lo", "<u2"), ("hi", "<u2"), ("h", "<u8"), ("ctx", "<u8"), ("ctx2", "<u4"), ("flag", "u1")),
    FULL: (("num", "<i8"), ("p", "<i4"), ("hi", "<u2")),
    ASK: (("num", "<i8"), ("a", "<i4"), ("lo", "<u2"), ("hi", "<u2"), ("h", "<u8"), ("flag", "u1")),
}


class Symbols(Protocol):
    """What differs between bytes and words."""

    width: int
    #: What parts packed stretches.
    gap: bytes

    def anchors(self, bodies: list[bytes]) -> Iterator[dict[str, np.ndarray]]:
        """Blocks of anchors: doc, a, lo (anchor less first window), hi (last less first window), h, ctx, ctx2."""

    #: Contexts of an anchor beyond which it is hot.
    hot: int

    def windows(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        """contexts() of each window of a packed stretch."""

    def pieces(self, body: bytes, start: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Stretches of symbols, packed."""

    def symbols(self, packed: bytes) -> np.ndarray:
        """The symbols of packed stretches one after the other; equal ones have one number."""

    def values(self, symbols: np.ndarray) -> np.ndarray: ...


@dataclass
class Block:
    kind: int
    columns: dict[str, np.ndarray]

    def rows(self, part: np.ndarray, parts: int) -> Iterator[tuple[int, int, int, bytes]]:
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(parts + 1))
        columns = [self.columns[name][order].astype(t, copy=False) for name, t in KINDS[self.kind]]
        for p in range(parts):
            i, j = ends[p], ends[p + 1]
            if i < j:
                yield p, self.kind, int(j - i), b"".join(c[i:j].tobytes() for c in columns)


def read_blocks(kinds, sizes, datas, kind: int) -> dict[str, np.ndarray]:
    """The columns of all blocks of one kind, joined."""
    fields = KINDS[kind]
    parts: dict[str, list[np.ndarray]] = {name: [] for name, _ in fields}
    for k, n, data in zip(kinds, sizes, datas):
        if k == kind:
            at = 0
            for name, t in fields:
                column = np.frombuffer(data, dtype=t, count=n, offset=at)
                at += column.nbytes
                parts[name].append(column)
    return {name: np.concatenate(parts[name]) if parts[name] else np.empty(0, dtype=t) for name, t in fields}


def contexts(body: bytes, start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of the digests of the stretches [start, end) of body, in 64 and 32; stretches with other lo or hi have others."""
    view = memoryview(body)
    digests = b"".join([blake2b(view[i:j], digest_size=12).digest() for i, j in zip(start.tolist(), end.tolist())])
    halves = np.frombuffer(digests, dtype=[("a", "<u8"), ("b", "<u4")])
    return halves["a"] + (lo * (1 << 20) + hi).astype(np.uint64) * LENGTH_SALT, halves["b"].astype(np.uint64)


def _by_hash(h: np.ndarray, parts: int) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) % parts


def _by_class(num: np.ndarray, parts: int) -> np.ndarray:
    return _by_hash(mix(num.astype(np.uint64)), parts)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "kind", "n", "data"])


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Number of the run of equal keys that each entry is in."""
    new = np.zeros(len(keys[0]), dtype=bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _combined(cells: dict[str, np.ndarray], parts: int) -> Iterator[tuple]:
    """Of anchors that agree in hash and context, one goes on, flagged; the windows of all are settled here."""
    order = np.lexsort((cells["ctx2"], cells["ctx"], cells["h"]))
    cells = {k: v[order] for k, v in cells.items()}
    run = _runs(cells["h"], cells["ctx"], cells["ctx2"])
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    size = np.bincount(run)
    flag = np.maximum.reduceat(cells["flag"], first)
    again = (size > 1)[run] & (cells["flag"] == 0)
    one = {k: v[first] for k, v in cells.items()}
    one["flag"] = np.where((size > 1) | (flag > 0), 1, 0).astype(np.uint8)
    back = np.lexsort((one["a"], one["num"]))  # documents together, for the compression of shuffled blocks
    one = {k: v[back] for k, v in one.items()}
    yield from Block(CELL, one).rows(_by_hash(one["h"], parts), parts)
    if again.any():
        full = {"num": cells["num"][again], "p": (cells["a"] - cells["lo"])[again], "hi": cells["hi"][again]}
        yield from Block(FULL, full).rows(_by_class(full["num"], parts), parts)


def _map_anchors(symbols: Symbols, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        n = 0
        for batch in batches:
            nums = batch.column("num").to_numpy()
            copies = batch.column("copies").to_numpy()
            bodies = batch.column("body")
            for docs, cells in _grouped(symbols, bodies):
                cells["num"] = nums[docs][cells["doc"]]
                cells["flag"] = (copies[docs][cells.pop("doc")] > 1).astype(np.uint8)
                cells = {k: v.astype(dict(KINDS[CELL])[k]) for k, v in cells.items()}
                held.append(cells)
                n += len(cells["h"])
                if n >= FLUSH:
                    yield _batch(list(_combined(_joined(held), parts)))
                    held, n = [], 0
        if n:
            yield _batch(list(_combined(_joined(held), parts)))

    return run


def _grouped(symbols: Symbols, bodies) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray]]]:
    """Anchors of bodies, about a megabyte of text at a time."""
    some: list[bytes] = []
    where: list[int] = []
    size = 0
    for k in range(len(bodies) + 1):
        if k < len(bodies):
            body = bodies[k].as_py()
            some.append(body)
            where.append(k)
            size += len(body)
        if some and (size >= 1 << 20 or k == len(bodies)):
            for cells in symbols.anchors(some):
                if len(cells["h"]):
                    yield np.array(where), cells
            some, where, size = [], [], 0


def _settled(cells: dict[str, np.ndarray], hot: int) -> tuple[dict[str, np.ndarray] | None, dict[str, np.ndarray] | None]:
    """(windows of anchors whose context comes twice, stretches to ask for) among the anchors of a bucket."""
    order = np.lexsort((cells["ctx2"], cells["ctx"], cells["h"]))
    # Only hashes that come twice matter.
    h = cells["h"][order]
    twice = np.zeros(len(h), dtype=bool)
    same = h[1:] == h[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    cells = {k: v[order[twice]] for k, v in cells.items()}
    if not len(cells["h"]):
        return None, None
    group, context = _runs(cells["h"]), _runs(cells["h"], cells["ctx"], cells["ctx2"])
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    multi = (np.bincount(context) > 1) | (np.maximum.reduceat(cells["flag"], first) > 0)
    full = multi[context] & (cells["flag"] == 0)
    found = {"num": cells["num"][full], "p": (cells["a"] - cells["lo"])[full], "hi": cells["hi"][full]} if full.any() else None
    # One stretch of each context, where an anchor has several and one of them isn't settled.
    of = group[first]
    contexts_of = np.bincount(of)
    unsettled = np.bincount(of, weights=~multi) > 0
    ask = first[((contexts_of > 1) & unsettled)[of]]
    if not len(ask):
        return found, None
    flag = multi[context[ask]].astype(np.uint8) | np.where(contexts_of[group[ask]] > hot, 2, 0).astype(np.uint8)
    return found, {k: cells[k][ask] for k in ("num", "a", "lo", "hi", "h")} | {"flag": flag}


def _passed(frame: pd.DataFrame) -> list[tuple]:
    """Blocks of settled windows, which pass through."""
    return [(int(p), FULL, int(s), d) for p, k, s, d in zip(frame["part"], frame["kind"], frame["n"], frame["data"]) if k == FULL]


def _settle(parts: int, hot: int):
    """Step 3, per bucket."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = _passed(frame)
        cells = read_blocks(frame["kind"].to_numpy(), frame["n"].to_numpy(), frame["data"].to_numpy(), CELL)
        if len(cells["h"]):
            for kind, some in zip((FULL, ASK), _settled(cells, hot)):
                if some is not None:
                    out += Block(kind, some).rows(_by_class(some["num"], parts), parts)
        return pd.DataFrame(out, columns=["part", "kind", "n", "data"])

    return run


def _gather(kind: int):
    """Blocks of a class bucket, as one row per class."""
    fields = [f for f in KINDS[kind] if f[0] != "num"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        c = read_blocks(frame["kind"].to_numpy(), frame["n"].to_numpy(), frame["data"].to_numpy(), kind)
        order = np.lexsort((c["p" if kind == FULL else "a"], c["num"]))
        c = {k: v[order] for k, v in c.items()}
        if kind == FULL and len(order):
            # Windows that overlap or follow each other, as one run.
            end = c["p"].astype(np.int64) + c["hi"]
            shift = _runs(c["num"]).astype(np.int64) << 40
            reach = np.maximum.accumulate(shift + end)
            new = np.r_[True, (shift + c["p"])[1:] > reach[:-1] + 1]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(end)] - 1
            nums = c["num"][first]
            cols = [c["p"][first].astype("<i4"), (reach - shift)[last].astype("<i4")]
        else:
            nums = c["num"]
            cols = [c[name] for name, _ in fields]
        cut = np.flatnonzero(np.r_[True, nums[1:] != nums[:-1]]) if len(nums) else np.empty(0, dtype=np.int64)
        ends = np.r_[cut[1:], len(nums)]
        rows = [(int(nums[i]), int(j - i), b"".join(x[i:j].tobytes() for x in cols)) for i, j in zip(cut, ends) if j > i]
        return pd.DataFrame(rows, columns=["num", "n", "data"])

    return run


def _unpack(data: bytes, n: int, types) -> list[np.ndarray]:
    out, at = [], 0
    for t in types:
        column = np.frombuffer(data, dtype=t, count=n, offset=at)
        at += column.nbytes
        out.append(column)
    return out


STRETCH = (("num", "<i8"), ("p", "<i4"), ("lo", "<u2"), ("hi", "<u2"), ("h", "<u8"), ("flag", "u1"))


def _cut_out(symbols: Symbols, parts: int):
    """Step 4, first half: the stretches that were asked for, cut from the texts; of hot anchors, their windows by digest."""

    def windows_of(num: int, start: np.ndarray, flag: np.ndarray, pieces: list[bytes]) -> dict[str, np.ndarray]:
        own = [symbols.windows(p) for p in pieces]
        n = np.array([len(ctx) for ctx, _ in own])
        place = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ctx, ctx2 = (np.concatenate([w[k] for w in own]) for k in (0, 1))
        flag = np.repeat(flag & 1, n)
        # A window may be in the stretches of several anchors; it is one occurrence.
        order = np.lexsort((1 - flag, place))
        one = order[np.r_[True, place[order][1:] != place[order][:-1]]]
        none = np.zeros(len(one), dtype=np.uint16)
        cells = {"num": np.full(len(one), num), "a": place[one], "lo": none, "hi": none, "h": ctx[one], "ctx": ctx[one], "ctx2": ctx2[one], "flag": flag[one]}
        return {k: v.astype(dict(KINDS[CELL])[k]) for k, v in cells.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [t for name, t in KINDS[ASK] if name != "num"]
        held: list[dict[str, np.ndarray]] = []
        n_held = 0
        for batch in batches:
            made: dict[int, list] = {}
            size = 0
            for num, n, data, body in zip(*(batch.column(c) for c in ("num", "n", "data", "body"))):
                a, lo, hi, h, flag = _unpack(data.as_py(), n.as_py(), types)
                part = _by_hash(h, parts)
                start = a - lo
                pieces = symbols.pieces(body.as_py(), start, hi.astype(np.int64) + symbols.width)
                hot = np.flatnonzero(flag & 2)
                if len(hot):
                    held.append(windows_of(num.as_py(), start[hot], flag[hot], [pieces[k] for k in hot]))
                    n_held += len(held[-1]["h"])
                for k in np.flatnonzero(~flag & 2).tolist():
                    made.setdefault(int(part[k]), []).append((num.as_py(), start[k], lo[k], hi[k], h[k], flag[k], pieces[k]))
                    size += len(pieces[k])
                if size > 8 << 20:
                    yield _batch(_stretches(made, symbols.gap))
                    made, size = {}, 0
                if n_held > FLUSH:
                    yield _batch(list(_combined(_joined(held), parts)))
                    held, n_held = [], 0
            yield _batch(_stretches(made, symbols.gap))
        if n_held:
            yield _batch(list(_combined(_joined(held), parts)))

    return run


def _joined(held: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([c[k] for c in held]) for k in held[0]}


def _stretches(made: dict[int, list], gap: bytes) -> list[tuple]:
    out = []
    for part, rows in made.items():
        columns = list(zip(*rows))
        heads = [np.array(c, dtype=t).tobytes() for c, (_, t) in zip(columns, STRETCH)]
        out.append((part, PIECES, len(rows), b"".join([*heads, gap.join(columns[6])])))
    return out


def _compare(symbols: Symbols, parts: int):
    """Step 4, second half: suffix-sort the windows of equal place in the stretches of an anchor; settle those that came by digest."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = _passed(frame)
        cells = read_blocks(frame["kind"].to_numpy(), frame["n"].to_numpy(), frame["data"].to_numpy(), CELL)
        if len(cells["h"]) and (found := _settled(cells, 0)[0]) is not None:
            out += Block(FULL, found).rows(_by_class(found["num"], parts), parts)
        frame = frame[frame["kind"] == PIECES]
        if len(frame):
            out += sorted_windows(frame)
        return pd.DataFrame(out, columns=["part", "kind", "n", "data"])

    def sorted_windows(frame: pd.DataFrame) -> list[tuple]:
        heads: dict[str, list[np.ndarray]] = {name: [] for name, _ in STRETCH}
        bodies = []
        for n, data in zip(frame["n"], frame["data"]):
            for (name, _), column in zip(STRETCH, _unpack(data, n, [t for _, t in STRETCH])):
                heads[name].append(column)
            bodies.append(data[n * sum(np.dtype(t).itemsize for _, t in STRETCH) :])
        c = {k: np.concatenate(v) for k, v in heads.items()}
        data = symbols.symbols(symbols.gap.join(bodies))
        length = c["hi"].astype(np.int64) + symbols.width
        at = np.cumsum(length) - length
        order = np.argsort(c["h"], kind="stable")
        group = _runs(c["h"][order])
        count = np.bincount(group)
        weight = np.bincount(group, weights=c["hi"][order].astype(np.int64) + 1)
        found = []
        ends = np.cumsum(count)
        i = g = 0
        while g < len(count):
            # Whole groups until enough windows are there.
            stop, windows = g, 0
            while stop < len(count) and (stop == g or windows + weight[stop] <= SORT_AT_ONCE):
                windows += weight[stop]
                stop += 1
            j = ends[stop - 1]
            found.append(_repeats(symbols, data, at, length, c, order[i:j], group[i:j], windows))
            i, g = j, stop
        num, p, hi = (np.concatenate(x) for x in zip(*found))
        return list(Block(FULL, {"num": num, "p": p, "hi": hi}).rows(_by_class(num, parts), parts))

    return run


def _repeats(symbols: Symbols, data, at, length, c, rows, group, windows):
    """(class, first window, further windows) of the runs of repeated windows among the stretches `rows`."""
    lengths = length[rows]
    base = np.cumsum(lengths) - lengths
    text = data[np.repeat(at[rows] - base, lengths) + np.arange(lengths.sum())]
    compare = SuffixOrder(text, symbols.values(text), symbols.width)
    lo, hi = c["lo"][rows].astype(np.int64), c["hi"][rows].astype(np.int64)
    out = []
    # Places relative to the anchor are independent; a large group goes through them in portions.
    least, most = int((lo - hi).min()), int(lo.max())
    step = most - least + 1 if windows <= 2 * SORT_AT_ONCE else max(1, SORT_AT_ONCE // len(rows))
    for x0 in range(least, most + 1, step):
        x1 = min(most + 1, x0 + step)
        # Window k of a stretch is at place lo - k.
        k0, k1 = np.maximum(0, lo - (x1 - 1)), np.minimum(hi, lo - x0)
        n = np.maximum(0, k1 - k0 + 1)
        if not n.sum():
            continue
        row = np.repeat(np.arange(len(rows)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + k0[row]
        key = group[row].astype(np.int64) * (1 << 20) + (lo[row] - k + (1 << 18))
        order = np.argsort(key, kind="stable")
        row, k, key = row[order], k[order], key[order]
        start = base[row] + k
        order = compare.sort(start, key)
        row, k, start = row[order], k[order], start[order]
        equal = compare.equal_neighbours(start, key)
        again = equal.copy()
        again[1:] |= equal[:-1]
        again &= c["flag"][rows][row] == 0
        out.append((row[again], k[again]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    row, k = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((k, row))
    row, k = row[order], k[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (k[1:] != k[:-1] + 1)]) if len(row) else np.empty(0, dtype=np.int64)
    last = np.r_[first[1:], len(row)] - 1 if len(row) else first
    return c["num"][rows[row[first]]], c["p"][rows[row[first]]] + k[first], k[last] - k[first]


def text_classes(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id and class of each row, one row per class: cls, num, copies, body).

    A class is the first half of the text's SHA-256. Equal texts meet after a partial aggregation,
    so each task sends one copy of a text however many it has. The class table is bucketed, so the
    texts cross the network once.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    cls = F.substring(F.unhex(F.sha2(body, 256)), 1, 16)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), cls.alias("cls"), body.alias("body"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reps = rows.groupBy("cls").agg(F.count("*").alias("copies"), F.first("body").alias("body"))
    reps = scratch.write(reps.withColumn("num", F.monotonically_increasing_id()), "classes", buckets=(parts, "cls"))
    return rows.select("doc_id", "cls"), reps


def repeated_windows(reps: DataFrame, symbols: Symbols, scratch: Scratch) -> DataFrame:
    """cls, n, data: the runs of repeated windows of each class that has some: n first and n last windows, 32-bit.

    Classes with several copies repeat in whole and are left to the caller.
    """
    # Texts take about twice their compressed size, and all that is dealt out about half their size.
    parts = parts_for(reps.sparkSession, scratch.size("classes"))
    ids = reps.select("num", "cls")
    cells = reps.select("num", "copies", "body").filter(F.octet_length("body") >= symbols.least_bytes).mapInArrow(tidied(_map_anchors(symbols, parts)), BLOCKS)
    settled = scratch.write(cells.groupBy("part").applyInPandas(_settle(parts, symbols.hot), BLOCKS), "settled")

    asked = settled.filter(F.col("kind") == ASK).groupBy("part").applyInPandas(_gather(ASK), "num bigint, n int, data binary")
    asked = asked.join(ids, "num").withColumnRenamed("num", "asked_num")
    cut = reps.join(asked.hint("shuffle_hash"), "cls").select("num", "n", "data", "body").mapInArrow(tidied(_cut_out(symbols, parts)), BLOCKS)
    edges = cut.groupBy("part").applyInPandas(_compare(symbols, parts), BLOCKS)
    full = settled.filter(F.col("kind") == FULL).unionByName(edges).groupBy("part").applyInPandas(_gather(FULL), "num bigint, n int, data binary")
    return full.join(ids, "num").select("cls", "n", "data")


def runs_of(n: int | None, data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) windows of the runs in a row of repeated_windows()."""
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    first, last = _unpack(data, n, ["<i4", "<i4"])
    return first.astype(np.int64), last.astype(np.int64)


def covered(first: np.ndarray, last: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of symbols in the windows of sorted, disjoint runs of windows."""
    spans: list[tuple[int, int]] = []
    for i, j in zip(first.tolist(), last.tolist()):
        if spans and i <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], j + width))
        else:
            spans.append((i, j + width))
    return spans
