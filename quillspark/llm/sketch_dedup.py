"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch has SIZE coordinates. In round i each shingle is hashed to one bin and a value; a bin keeps
the least value of the first round that reaches it. The first SIZE rounds pick bins at random, the
next SIZE send every shingle to bin i - SIZE, so after at most 2 * SIZE rounds each coordinate is
filled whatever the set's size, and most sets need a few (Dahlgaard, Knudsen, Thorup 2017). Two sets
agree in a coordinate with the probability of their Jaccard similarity, and the number of agreeing
coordinates is concentrated as that of independent ones.

BANDS bands of ROWS coordinates: sets of similarity 0.8 share no band with probability
(1 - 0.8^5)^40 = 1.3e-7. Whoever shares a band with another is compared on full sets.

Members of a band's bucket are first compared with one of them, then, round by round, with a random
one of another component, until most of what can meet has met. Then sketches, a byte a coordinate, of
members of different components are compared within crowds, connected over all open buckets. Whoever
shares a band with another and agrees with it in enough coordinates for a link not to be ruled out is
compared on full sets. So a bucket of n copies costs a few times n comparisons of texts, and texts that
share a passage alone are parted by their sketches and sent nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, few, parts_for, tidied
from .components import components
from .repeats import text_classes
from .rolling import LENGTH_SALT, Prefixes, mix

U = np.uint64
SIZE, BANDS, ROWS = 200, 40, 5
_RNG = np.random.default_rng(77)
ROUND_SALTS = _RNG.integers(0, 1 << 64, size=2 * SIZE, dtype=np.uint64)
BAND_SALTS = _RNG.integers(0, 1 << 64, size=BANDS, dtype=np.uint64)
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
EMPTY = U((1 << 64) - 1)
#: Words whose hashes a task remembers.
KNOWN_WORDS = 500_000

#: Members compared with one set in one task; members of a bucket that one random member is taken for.
PER_TASK, PIVOT_ROWS = 256, 512
#: Of SIZE coordinates, 160 agree on average at similarity 0.8, with a deviation of 5.7; fewer than 130 do with
#: probability 1e-7.
LEAST_AGREE = 130
#: What meets in one task of the last pass, at most about twice: sketches, then texts in number and in bytes. A crowd
#: is parted into up to BLOCKS blocks of sketches before these grow from the least size to the largest.
LEAST_BLOCK, BLOCK_ROWS, BLOCKS, TEXT_ROWS, TEXT_BYTES = 512, 4096, 32, 2048, 8 << 20


class WordHashes(dict):
    """64 bits of the keyed BLAKE2b of words, each worked out once; forgotten when there are too many."""

    def __init__(self, key: bytes = b""):
        super().__init__()
        self.key = key

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = h = int.from_bytes(blake2b(word, digest_size=8, key=self.key).digest(), "little")
        return h

    def of(self, body: bytes) -> np.ndarray:
        """Hashes of the words of a text, A-Z lower-cased."""
        found = body.translate(LOWER).split()
        return np.fromiter(map(self.__getitem__, found), dtype=np.uint64, count=len(found))


def shingles(bodies: list[bytes], n: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(ends, hashes): the distinct n-word shingles of each text, sorted within it; ends is cumulative."""
    each = [hashes.of(b) for b in bodies]
    counts = np.array([len(x) for x in each], dtype=np.int64)
    symbols = np.concatenate([*each, np.empty(0, dtype=np.uint64)])
    base = np.cumsum(counts) - counts
    have = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(bodies)), have)
    start = np.arange(have.sum()) - np.repeat(np.cumsum(have) - have, have) + base[doc]
    size = np.minimum(counts, n)[doc]
    h = mix(Prefixes(symbols).of(start, start + size) + size.astype(np.uint64) * LENGTH_SALT)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return np.cumsum(np.bincount(doc[keep], minlength=len(bodies))), h[keep]


def exact(body: bytes, n: int) -> set[bytes]:
    """The shingles of a text themselves."""
    w = body.translate(LOWER).split()
    return {b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {b" ".join(w)} if w else set()


def alike(x: set[bytes], y: set[bytes], least: int) -> bool:
    shared = len(x & y)
    return 100 * shared >= least * (len(x) + len(y) - shared)


def sketches(ends: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One row of SIZE coordinates per set; rows of empty sets stay EMPTY."""
    n = np.diff(np.r_[0, ends])
    out = np.full(len(n) * SIZE, EMPTY, dtype=np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    for k in range(2 * SIZE):
        if not len(h):
            break
        x = mix(h ^ ROUND_SALTS[k])
        bins = ((x >> U(32)) * U(SIZE) >> U(32)).astype(np.int64) if k < SIZE else k - SIZE
        np.minimum.at(out, doc * SIZE + bins, (x & U((1 << 48) - 1)) | U(k << 48))
        # Sets with all bins full are done.
        todo = (out.reshape(-1, SIZE) == EMPTY).any(axis=1)[doc]
        h, doc = h[todo], doc[todo]
    return out.reshape(-1, SIZE)


def bands(sketch: np.ndarray) -> np.ndarray:
    """BANDS hashes per sketch."""
    cells = sketch.reshape(-1, BANDS, ROWS)
    acc = np.broadcast_to(BAND_SALTS, cells.shape[:2]).copy()
    for k in range(ROWS):
        acc = mix(acc ^ (cells[:, :, k] * LENGTH_SALT))
    return acc


def marks(sketch: np.ndarray) -> np.ndarray:
    """The low byte of each coordinate."""
    return (sketch & U(255)).astype(np.uint8)


def may_link(cells: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Which rows of cells (marks) may be linked with one: a band in common, and not too few coordinates."""
    same = cells == one
    out = np.count_nonzero(same, axis=1) >= LEAST_AGREE
    out[out] = same[out].reshape(-1, BANDS, ROWS).all(axis=2).any(axis=1)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    start, held, total = 0, [], 0
    column = batch.column("body")
    for k in range(batch.num_rows):
        body = column[k].as_py()
        held.append(body)
        total += len(body)
        if total >= size or k == batch.num_rows - 1:
            yield batch.slice(start, k + 1 - start), held
            start, held, total = k + 1, [], 0


def _sign(n_words: int, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(key)
        for batch in batches:
            for part, bodies in _slices(batch, 1 << 20):
                ends, h = shingles(bodies, n_words, hashes)
                n = np.diff(np.r_[0, ends])
                sketch = sketches(ends, h)
                columns = [part.column("num"), pa.array(n.astype(np.int64)), pa.array([r.tobytes() for r in bands(sketch)], pa.binary())]
                columns += [pa.array([r.tobytes() for r in marks(sketch)], pa.binary()), pa.array([len(b) for b in bodies], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["num", "n_shingles", "bands", "marks", "size"])

    return run


def _deal(parts: int):
    """Band hashes of sets, in blocks by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            num = batch.column("num").to_numpy()
            h = np.frombuffer(b"".join(batch.column("bands").to_pylist()), dtype="<u8")
            num = np.repeat(num, BANDS)
            part = (h >> U(40)).astype(np.int64) % parts
            order = np.argsort(part, kind="stable")
            h, num, part = h[order], num[order], part[order]
            cut = np.searchsorted(part, np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cut))
            data = [num[cut[p] : cut[p + 1]].tobytes() + h[cut[p] : cut[p + 1]].tobytes() for p in some]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.diff(cut)[some].astype(np.int32)), pa.array(data, pa.binary())], names=["part", "n", "data"])

    return run


def _buckets(frame: pd.DataFrame) -> pd.DataFrame:
    """bucket, num and pivot (least num of the bucket) of buckets with several members."""
    num = np.concatenate([np.frombuffer(d, dtype="<i8", count=n) for n, d in zip(frame["n"], frame["data"])])
    h = np.concatenate([np.frombuffer(d, dtype="<u8", count=n, offset=8 * n) for n, d in zip(frame["n"], frame["data"])])
    order = np.lexsort((num, h))
    h, num = h[order], num[order]
    first = np.r_[True, h[1:] != h[:-1]]
    run = np.cumsum(first) - 1
    size = np.bincount(run)
    several = size[run] > 1
    pivot = num[first][run]
    return pd.DataFrame({"bucket": _signed(h[several]), "num": num[several], "pivot": pivot[several]})


def _messages(keys: list, roles: list, roots: list, nums: list, bodies: list) -> pa.RecordBatch:
    columns = [pa.array(keys, pa.int64()), pa.array(roles, pa.int32()), pa.array(roots, pa.int64()), pa.array(nums, pa.int64()), pa.array(bodies, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["key", "role", "root", "num", "body"])


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to the comparisons they take part in."""
    for batch in batches:
        keys, roles, roots, nums, bodies = [], [], [], [], []
        size = 0
        for num, wanted, body in zip(batch.column("num").to_pylist(), batch.column("wanted").to_pylist(), batch.column("body")):
            text = body.as_py()
            for w in wanted:
                keys.append(w["key"])
                roles.append(w["role"])
                roots.append(w["root"])
                nums.append(num)
                bodies.append(text)
                size += len(text)
                if size > 4 << 20:
                    yield _messages(keys, roles, roots, nums, bodies)
                    keys, roles, roots, nums, bodies, size = [], [], [], [], [], 0
        yield _messages(keys, roles, roots, nums, bodies)


def _verify(n_words: int, least: int, key: bytes):
    """Links among the pairs (role 0, role 1) of each key, on full sets: of hashes, then of the shingles themselves."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHashes(key)
        frame = frame.sort_values(["key", "role"], kind="stable")
        keys, role, num, bodies = frame["key"].to_numpy(), frame["role"].to_numpy(), frame["num"].to_numpy(), frame["body"].tolist()
        a, b = [], []
        pivot, pivot_num, at, pivot_set = None, 0, None, None
        for start in range(0, len(bodies), 256):
            ends, h = shingles(bodies[start : start + 256], n_words, hashes)
            for k in range(len(ends)):
                own = h[ends[k - 1] if k else 0 : ends[k]]
                i = start + k
                if role[i] == 0:
                    pivot, pivot_num, at, pivot_set, pivot_body = own.copy(), num[i], keys[i], None, bodies[i]
                elif keys[i] == at and len(own):
                    where = np.searchsorted(pivot, own)
                    where[where == len(pivot)] = 0
                    shared = int((pivot[where] == own).sum())
                    if 100 * shared >= least * (len(pivot) + len(own) - shared):
                        if pivot_set is None:
                            pivot_set = exact(pivot_body, n_words)
                        if not alike(exact(bodies[i], n_words), pivot_set, least):
                            continue
                        a.append(num[i])
                        b.append(pivot_num)
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    return run


def _sent(wanted: DataFrame, reps: DataFrame, ids: DataFrame) -> DataFrame:
    """key, role, root, num and body: the texts of wanted(num, wanted), one for each comparison they take part in."""
    wanted = wanted.join(ids, "num").withColumnRenamed("num", "wanted_num")
    rows = reps.join(wanted.hint("shuffle_hash"), "cls").select(F.col("wanted_num").alias("num"), "wanted", "body")
    return rows.mapInArrow(_send, "key bigint, role int, root bigint, num bigint, body binary")


def _verified(pairs: DataFrame, reps: DataFrame, ids: DataFrame, n_words: int, least: int, key: bytes, parts: int) -> DataFrame:
    """The pairs (num, pivot) that link. A pivot with many partners is dealt out over many keys."""
    many = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / PER_TASK).alias("salts"))
    keyed = pairs.join(many, "pivot").withColumn("key", F.xxhash64("pivot", F.pmod(F.xxhash64("num"), F.col("salts"))))
    wanted = keyed.select("num", "key", F.lit(1).alias("role")).unionByName(keyed.select(F.col("pivot").alias("num"), "key", F.lit(0).alias("role")).distinct())
    wanted = wanted.groupBy("num").agg(F.collect_list(F.struct("key", "role", F.lit(0).cast("long").alias("root"))).alias("wanted"))
    return _sent(wanted, reps, ids).groupBy(F.pmod(F.col("key"), F.lit(4 * parts)).alias("part")).applyInPandas(_verify(n_words, least, key), "a bigint, b bigint")


def _candidates(frame: pd.DataFrame) -> pd.DataFrame:
    """key and num of members of one or two blocks whose sketch may link with that of another component's member there."""
    frame = frame.sort_values("key", kind="stable")
    key, root, num, block = (frame[c].to_numpy() for c in ("key", "root", "num", "role"))
    cells = np.frombuffer(b"".join(frame["marks"]), dtype=np.uint8).reshape(-1, SIZE)
    found = np.zeros(len(key), dtype=bool)
    cut = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
        two = block[i:j].min() != block[i:j].max()
        for k in range(i, j - 1):
            at = np.flatnonzero((root[k + 1 : j] != root[k]) & ((block[k + 1 : j] != block[k]) if two else True)) + k + 1
            if len(at) and (hit := at[may_link(cells[at], cells[k])]).size:
                found[hit] = found[k] = True
    return pd.DataFrame({"key": key[found], "num": num[found]})


def _meet(n_words: int, least: int, key: bytes):
    """Links between members of different components in one or two blocks of a crowd, a spanning set of them.

    Of two blocks, only pairs across count, as each block also meets itself. Blocks bound what is
    compared at once. Sketches part most pairs; the rest are compared on full sets, but for those
    that links found before have joined.
    """

    hashes = WordHashes(key)

    def one(root, num, block, bodies, out):
        members: dict[int, list[int]] = {}
        for k, r in enumerate(root.tolist()):
            members.setdefault(r, []).append(k)
        if len(members) < 2:
            return
        sets, some = [], []
        for start in range(0, len(bodies), 256):
            ends, h = shingles(bodies[start : start + 256], n_words, hashes)
            sets += np.split(h, ends[:-1])
            some.append(marks(sketches(ends, h)))
        cells, label = np.concatenate(some), root.copy()
        two = block.min() != block.max()
        for k in range(len(sets) - 1):
            at = np.flatnonzero((label[k + 1 :] != label[k]) & ((block[k + 1 :] != block[k]) if two else True)) + k + 1
            if not len(at):
                continue
            at = at[may_link(cells[at], cells[k])]
            for j in at.tolist():
                if label[j] == label[k]:
                    continue
                x, y = (sets[k], sets[j]) if len(sets[k]) < len(sets[j]) else (sets[j], sets[k])
                if 100 * len(x) < least * len(y):
                    continue
                where = np.searchsorted(y, x)
                where[where == len(y)] = 0
                shared = int((y[where] == x).sum())
                if 100 * shared >= least * (len(x) + len(y) - shared) and alike(exact(bodies[j], n_words), exact(bodies[k], n_words), least):
                    out.append((num[j], num[k]))
                    gone, stays = label[j], label[k]
                    label[members[gone]] = stays
                    members[stays] += members.pop(gone)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "role", "num"], kind="stable")
        key, root, num, block, bodies = frame["key"].to_numpy(), frame["root"].to_numpy(), frame["num"].to_numpy(), frame["role"].to_numpy(), frame["body"].tolist()
        out: list[tuple[int, int]] = []
        cut = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
        for i, j in zip(cut[:-1], cut[1:]):
            one(root[i:j], num[i:j], block[i:j], bodies[i:j], out)
        pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _open(cells: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """(bucket, num, root, n of the members of buckets that hold several components, `rows` in all; bucket and main, the largest of these)."""
    labelled = cells.join(labels, "num")
    sizes = labelled.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("components"), F.max(F.struct("n", "root"))["root"].alias("main")).filter("components > 1")
    return labelled.join(few(largest.select("bucket", "n"), rows), "bucket"), largest.select("bucket", "main")


def _linked(pairs, labels, cells, reps, ids, n_words, similarity, key, parts, scratch, name, n_pairs, n_labels):
    """(labels after the pairs that link; what is left: rows of open buckets, and pairs that an exact pass would compare).

    Components are found on the graph of roots, which shrinks from round to round.
    """
    return _joined(_verified(pairs, reps, ids, n_words, similarity, key, parts), labels, cells, scratch, name, n_pairs, n_labels)


def _joined(links, labels, cells, scratch, name, n_links, n_labels):
    """_linked() from links on; n_links and n_labels are bounds, or None."""
    ra, rb = (labels.select(F.col("num").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
    edges = scratch.write(links.join(ra, "a").join(rb, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), f"{name}-links", rows=n_links)
    moved = components(edges, scratch, f"{name}-c", n_links)
    labels = scratch.write(labels.join(moved.withColumnRenamed("root", "top"), F.col("root") == F.col("node"), "left").select("num", F.coalesce("top", "root").alias("root")), f"{name}-labels", rows=n_labels)
    sizes = cells.join(labels, "num").groupBy("bucket", "root").agg(F.count("*").alias("m")).groupBy("bucket").agg(F.sum("m").alias("n"), F.max("m").alias("m")).filter("m < n")
    state = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.expr("(n - m) * n")), F.lit(0)).alias("pairs")).first()
    return labels, state


def near_duplicates(docs: DataFrame, n_words: int = 5, similarity: int = 80, id_col: str = "doc_id", text_col: str = "text", with_class: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per row; with_class adds cls, half the SHA-256 of the text.

    Shingles are n_words lower-cased words (A-Z only); a text of fewer words has its whole sequence
    as one, one without words has none and links with nothing. Texts whose sets have a Jaccard
    similarity of `similarity` per cent (80 at least) or more are linked; component_id is the least id reachable.
    Null texts are empty. Null ids count as the largest and stay null. Rows that repeat are in one
    component. An empty table gives no rows. Texts are read whole, of any length: a task holds one at a
    time besides about a megabyte of others, and pairs by two. Other columns are not read.
    """
    if similarity < 80:
        raise ValueError("bands and the sketch filter are made for a similarity of 80 or more; less would lose links")
    spark = docs.sparkSession
    scratch = Scratch(spark, "sketch-dedup")
    members, reps = text_classes(docs, scratch, id_col, text_col)
    parts = parts_for(spark, scratch.size("classes"))
    n = reps.agg(F.count("*").alias("classes"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"), F.expr("bit_xor(xxhash64(1, cls))").alias("x"), F.expr("bit_xor(xxhash64(2, cls))").alias("y")).first()
    # Words are hashed under a key that all texts together make, so no word can be made to hash like another.
    key = ((n.x or 0) % (1 << 64)).to_bytes(8, "little") + ((n.y or 0) % (1 << 64)).to_bytes(8, "little")
    ids = reps.select("num", "cls")
    signs = scratch.write(reps.select("num", "body").mapInArrow(tidied(_sign(n_words, key)), "num bigint, n_shingles bigint, bands binary, marks binary, size bigint"), "signs")

    # Equal sets share all bands and are compared like others: nothing is linked by hashes alone.
    dealt = signs.filter("n_shingles > 0").select("num", "bands").mapInArrow(_deal(parts), "part int, n int, data binary")
    live = scratch.write(dealt.groupBy("part").applyInPandas(_buckets, "bucket bigint, num bigint, pivot bigint"), "live", rows=BANDS * n.classes)

    first = scratch.write(live.filter("num <> pivot").groupBy("num").agg(F.min("pivot").alias("pivot")), "tried", rows=n.classes)
    cells = live.select("bucket", "num")
    labels = scratch.write(cells.select("num").distinct().withColumn("root", F.col("num")), "labels", rows=n.classes)
    labels, state = _linked(first, labels, cells, reps, ids, n_words, similarity, key, parts, scratch, "first", n.classes, n.classes)
    tried = first

    # Members of buckets that are not yet one component, against a random member each, while that
    # still brings down what an exact pass would have to compare by a fifth a round.
    before, k = None, 0
    while state.pairs > state.rows and (before is None or state.pairs < 0.8 * before):
        before, k = state.pairs, k + 1
        inside, _ = _open(cells, labels, state.rows)
        dealt_members = inside.withColumn("salt", F.pmod(F.xxhash64("num", F.lit(k)), F.ceil(F.col("n") / PIVOT_ROWS)))
        pivots = dealt_members.groupBy("bucket", "salt").agg(F.min_by(F.struct(F.col("num").alias("pivot"), F.col("root").alias("pivot_root")), F.xxhash64("num", F.lit(-k))).alias("p"))
        pairs = dealt_members.join(pivots, ["bucket", "salt"]).filter("root <> p.pivot_root").select(F.greatest("num", "p.pivot").alias("num"), F.least("num", "p.pivot").alias("pivot")).distinct()
        pairs = scratch.write(pairs.join(tried, ["num", "pivot"], "left_anti"), f"round-{k}", rows=state.rows)
        labels, state = _linked(pairs, labels, cells, reps, ids, n_words, similarity, key, parts, scratch, f"round-{k}", state.rows, n.classes)
        tried = tried.unionByName(pairs)

    # The last pass: whoever can still meet through open buckets, in blocks, by sketch and then in full.
    # A crowd is connected over all open buckets. Each sketch goes to every block of its crowd; texts go only
    # to the blocks in which their sketch found another component's that may link.
    if state.pairs:
        inside, _ = _open(cells, labels, state.rows)
        inside = scratch.write(inside.select("bucket", "num"), "inside", rows=state.rows)
        heads = inside.groupBy("bucket").agg(F.min("num").alias("head"))
        near = components(inside.join(few(heads, state.rows), "bucket").select(F.col("num").alias("a"), F.col("head").alias("b")), scratch, "near", state.rows)
        crowd = inside.select("num").distinct().join(near, F.col("num") == F.col("node"), "left").select("num", F.coalesce("root", "num").alias("crowd")).join(labels, "num")
        crowd = scratch.write(crowd, "crowd", rows=n.classes)
        own = F.pmod(F.xxhash64("num"), F.col("blocks")).cast("int")
        meet = F.transform(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1), lambda j: F.struct(F.xxhash64("crowd", F.least(own, j), F.greatest(own, j)).alias("key"), own.alias("role"), F.col("root").alias("root")))
        crowd = crowd.join(signs.select("num", "marks", "size"), "num")
        in_blocks = lambda df, n: df.join(df.groupBy("crowd").agg(n.cast("long").alias("blocks")), "crowd").select("num", "root", "crowd", "size", "marks", F.explode(meet).alias("m"))
        block_rows = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(LEAST_BLOCK), F.count("*") / BLOCKS))
        sketched = in_blocks(crowd, F.ceil(F.count("*") / block_rows)).select("num", "m.key", "m.role", "m.root", "marks")
        pairs = sketched.groupBy(F.pmod(F.col("key"), F.lit(parts)).alias("part")).applyInPandas(_candidates, "key bigint, num bigint")
        asked = scratch.write(pairs.select("num").distinct(), "asked", rows=n.classes)
        # Blocks of texts are those of the members that were found, dealt anew by number and bytes.
        left = crowd.join(asked, "num", "left_semi").drop("marks").withColumn("marks", F.lit(None).cast("binary"))
        texts = in_blocks(left, F.greatest(F.ceil(F.count("*") / TEXT_ROWS), F.ceil(F.sum("size") / TEXT_BYTES)))
        texts = scratch.write(texts.select("num", "size", "m"), "meetings")
        size = texts.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
        wanted = texts.groupBy("num").agg(F.collect_list("m").alias("wanted"))
        links = _sent(wanted, reps, ids).groupBy(F.pmod(F.col("key"), F.lit(parts_for(spark, size))).alias("part")).applyInPandas(_meet(n_words, similarity, key), "a bigint, b bigint")
        labels, _ = _joined(links, labels, cells, scratch, "last", None, n.classes)
    rooted = labels.select(F.col("num").alias("node"), F.col("root").alias("top"))

    # Text class -> component, then the least id of each component.
    known = signs.select("num", "n_shingles").join(rooted, F.col("num") == F.col("node"), "left")
    known = known.select("num", "n_shingles", F.coalesce("top", F.when(F.col("n_shingles") > 0, F.col("num"))).alias("component")).join(ids, "num")
    known = scratch.write(known.select("cls", "n_shingles", "component"), "known", rows=n.classes)
    rows = scratch.write(members.join(known, "cls").select("doc_id", "cls", "n_shingles", "component"), "rows", rows=n.rows)
    least = rows.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    for name in ("signs", "live"):
        scratch.drop(name)
    return rows.join(least, "component", "left").select(
        "doc_id",
        *["cls"] * with_class,
        "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("doc_id").eqNullSafe(F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))).alias("kept"),
    )


def one_of_each(docs: DataFrame, n_words: int = 5, similarity: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with their columns, that stay: of each component the one with the least id.

    Of rows with that id, the text with the least class stays, once. Texts without words link with
    nothing: of these, one row per id stays.
    """
    scratch = Scratch(docs.sparkSession, "near-kept")
    stay_rows = docs.count()
    marks = near_duplicates(docs, n_words, similarity, id_col, text_col, with_class=True)
    stay = marks.filter("kept").groupBy(F.col("doc_id").alias("_id")).agg(F.min("cls").alias("_cls"))
    stay = scratch.write(stay, "stay", rows=stay_rows)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_key"), F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("_text"))
    # Both sides are dealt by (id, class), so repeated rows of one key are in one task already.
    found = rows.join(stay.hint("shuffle_hash"), F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_cls")), "left_semi")
    return found.dropDuplicates(["_key", "_text"]).select("_row.*")
