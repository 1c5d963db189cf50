"""The prefix trie of conversations: who shares which first turns with whom.

A node stands for a distinct sequence of first d turns and is owned by the smallest conversation that
starts with it. Along a conversation owners only grow, so what it owns is a chain: from its first
owned depth, which may lie behind its end (an equal conversation with a smaller id owns all), down to
its last turn. The chain hangs below the node before it, which the last failed probe named.

1. A conversation's prefix digests are chained SHA-256, in pieces of PIECE turns whose heads are chained
   in the same way, so a conversation of any length is spread over many tasks.
2. The least conversation and the number of conversations per digest: one row a node.
3. All conversations search their first owned depth at once, by halving; a round joins one digest of
   each with the table of 2.
4. Totals of chains go up by pointer doubling: rounds follow the logarithm of the chain tree's height.
5. Along a chain, totals from its end on are running sums, of chains of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, parts_for, tidied
from .running import running

#: Turns whose digests are chained in one row.
PIECE = 32
#: At most HEAVY keys can hold more than a HEAVY-th part of all rows each; their rows are broadcast.
HEAVY = 1000
#: Decimal ids that go as one string.
IDS = 4096
#: First turns that a conversation may take from another, and how many conversations one serves.
MOST_TAKEN, FAMILY = 5, 100
#: About what a row of digests takes.
ROW_BYTES = 80


def _sha(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def chained(df: DataFrame, longest: int, scratch: Scratch, name: str) -> DataFrame:
    """df (conv, place, digest and others) with digest replaced by that of all digests of conv up to the place."""
    others = [c for c in df.columns if c not in ("conv", "place", "digest")]
    piece = F.expr(f"(place - 1) div {PIECE}").alias("piece")
    pieces = df.groupBy("conv", piece).agg(F.array_sort(F.collect_list(F.struct("place", "digest", *others))).alias("cells"))
    step = lambda so_far, x: F.concat(so_far, F.array(_sha(F.element_at(so_far, -1), x["digest"])))
    runs = F.slice(F.aggregate("cells", F.array(F.lit(bytearray(b""))), step), 2, PIECE)
    pieces = pieces.withColumn("runs", runs)
    digest = F.col("x.run")
    if longest > PIECE:
        pieces = scratch.write(pieces, f"{name}-pieces")
        heads = chained(pieces.select("conv", (F.col("piece") + 1).alias("place"), F.element_at("runs", -1).alias("digest")), -(-longest // PIECE), scratch, f"{name}-heads")
        heads = heads.select(F.col("conv").alias("_conv"), F.col("place").alias("_place"), F.col("digest").alias("before"))
        pieces = pieces.join(heads, (F.col("conv") == F.col("_conv")) & (F.col("piece") == F.col("_place")), "left")
        digest = F.when(F.col("before").isNull(), digest).otherwise(_sha(F.lit(bytearray(b"+")), F.col("before"), digest))
    else:
        pieces = pieces.withColumn("before", F.lit(None).cast("binary"))
    cells = F.transform(F.sequence(F.lit(1), F.size("cells")), lambda k: F.struct(F.element_at("cells", k).alias("cell"), F.element_at("runs", k).alias("run")))
    rows = pieces.select("conv", "before", F.explode(cells).alias("x"))
    return rows.select("conv", "x.cell.place", digest.alias("digest"), *(F.col(f"x.cell.{c}") for c in others))


def looked_up(left: DataFrame, key: str, table: DataFrame, heavy: DataFrame, none: Column) -> DataFrame:
    """left with the columns of table, unique by key, or nulls. Keys in heavy, at most HEAVY, are looked up by broadcast.

    Rows that are served so, and those without a key, go to the shuffled join with `none`, which equals
    no key and differs from row to row: no task gets many of them. Keys are strings or bytes.
    """
    values = [c for c in table.columns if c != key]
    hot = table.join(F.broadcast(heavy.select(key)), key, "left_semi").select(F.col(key).alias("_hot"), *(F.col(c).alias(f"_hot_{c}") for c in values))
    marked = left.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    marked = marked.withColumn("_own", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(none))
    cold = table.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_cold_{c}") for c in values))
    joined = marked.join(cold, F.col("_own") == F.col("_key"), "left")
    return joined.select(*left.columns, *(F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in values))


def placed_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, scratch: Scratch, parts: int) -> DataFrame:
    """conv, place, digest of (role, text) and code points of the text. Texts are read once and go no further."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        role.alias("role"),
        _sha(F.octet_length(role).cast("string"), F.lit("|"), role, text).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
    ).filter("conv is not null")
    return running(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")], "place", {}, scratch, "placed", parts).drop("turn", "role")


def rebuilt(placed: DataFrame, scratch: Scratch, parts: int) -> DataFrame:
    """The turns of the rebuilt conversations: conv, place, digest, chars.

    The first h turns come from conversation conv - conv % 100, h = crc32(conv) % 6; a conversation's
    own first h turns go.
    """
    taken = (F.crc32(F.col("conv").cast("string")) % (MOST_TAKEN + 1)).cast("long")
    base = F.col("conv") - F.col("conv") % FAMILY
    convs = placed.select("conv").distinct().select("conv", taken.alias("taken"), base.alias("base")).filter("taken > 0")
    firsts = placed.filter(F.col("place") <= MOST_TAKEN).select(F.col("conv").alias("base"), "place", "digest", "chars")
    lent = convs.join(firsts, "base").filter(F.col("place") <= F.col("taken")).select("conv", F.lit(0).alias("own"), F.col("place").alias("was"), "digest", "chars")
    own = placed.filter(F.col("place") > taken).select("conv", F.lit(1).alias("own"), F.col("place").alias("was"), "digest", "chars")
    return running(lent.unionByName(own), "conv", [F.col("own"), F.col("was")], "place", {}, scratch, "rebuilt", parts).select("conv", "place", "digest", "chars")


def _first_owned(lengths: DataFrame, prefixes: DataFrame, nodes: DataFrame, least: int, longest: int, total: int, scratch: Scratch) -> DataFrame:
    """conv, length, first (owned depth, or length + 1) and parent, who owns the node before it."""
    state = lengths.select("conv", "length", F.lit(1).cast("long").alias("lo"), (F.col("length") + 1).alias("hi"), F.lit(least).cast("long").alias("parent"))
    owners = nodes.select("digest", F.col("conv_id").alias("owner"))
    heavy = nodes.filter(F.col("n_convs") > total / HEAVY).select("digest")
    for k in range(longest.bit_length()):
        probes = state.withColumn("depth", F.when(F.col("lo") < F.col("hi"), F.expr("(lo + hi) div 2")))
        probes = probes.join(prefixes.select("conv", F.col("place").alias("depth"), "digest"), ["conv", "depth"], "left")
        seen = looked_up(probes, "digest", owners, heavy, _sha(F.lit("~"), F.col("conv").cast("string")))
        mine, other = F.col("owner") == F.col("conv"), F.col("owner") != F.col("conv")
        state = seen.select(
            "conv", "length",
            F.when(other, F.col("depth") + 1).otherwise(F.col("lo")).alias("lo"),
            F.when(mine, F.col("depth")).otherwise(F.col("hi")).alias("hi"),
            F.when(other, F.col("owner")).otherwise(F.col("parent")).alias("parent"),
        )
        state = scratch.write(state, f"search-{k}")
        if k:
            scratch.drop(f"search-{k - 1}")
    top = F.col("conv") == least
    return state.select("conv", "length", F.when(top, 0).otherwise(F.col("lo")).alias("first"), F.when(~top, F.col("parent")).alias("parent"))


def _totals(chains: DataFrame, n_chains: int, scratch: Scratch) -> DataFrame:
    """conv, leaves and saved of each chain with all chains below it.

    After round k a chain has the sums of what is less than 2^k chains below it and points at the one
    2^k above; whoever points at it brings the next 2^k.
    """
    state, k = scratch.write(chains.select("conv", F.col("parent").alias("up"), "leaves", "saved"), "totals-0"), 0
    while not state.filter("up is not null").isEmpty():
        below = scratch.write(state.filter("up is not null").groupBy("up").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"), F.count("*").alias("n")), f"below-{k}")
        at = F.col("up").cast("string").alias("at")
        heavy = below.filter(F.col("n") > n_chains / HEAVY).select(at)
        above = state.select(F.col("conv").cast("string").alias("at"), F.col("up").alias("next"))
        sums = state.join(below.drop("n").withColumnRenamed("up", "conv"), "conv", "left").withColumn("at", at)
        new = looked_up(sums, "at", above, heavy, F.concat(F.lit("~"), F.col("conv").cast("string"))).select("conv", F.col("next").alias("up"), *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")))
        k += 1
        state = scratch.write(new, f"totals-{k}")
        scratch.drop(f"totals-{k - 1}")
        scratch.drop(f"below-{k - 1}")
    return state.select("conv", "leaves", "saved")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of nodes, IDS at a time as one string, with the first of them."""

    def out(done):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "least", "ids"])

    at, some, done = None, [], []
    for batch in batches:
        for conv, depth, one in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "id"))):
            if some and (at != (conv, depth) or len(some) == IDS):
                done.append((*at, some[0], ",".join(map(str, some))))
                some = []
            at = (conv, depth)
            some.append(one)
        if len(done) > 10_000:
            yield out(done)
            done = []
    if some:
        done.append((*at, some[0], ",".join(map(str, some))))
    if done:
        yield out(done)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of all strings of a node, in order and joined by commas, one string in memory at a time."""
    at, state = None, None
    for batch in batches:
        done = []
        for conv, depth, ids in zip(*(batch.column(c) for c in ("conv_id", "depth", "ids"))):
            key = (conv.as_py(), depth.as_py())
            if key == at:
                state.update(b",")
            else:
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = key, hashlib.sha256()
            state.update(ids.as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["conv_id", "depth", "ends_sha256"])
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, state.hexdigest())], names=["conv_id", "depth", "ends_sha256"])


def _ends(chains: DataFrame, parts: int) -> DataFrame:
    """conv_id, depth and ends_sha256 of the nodes at which conversations end.

    Runs of ids become strings where they lie; a node at which a third of all conversations end costs its
    one task a stream of these strings.
    """
    ends = chains.select(F.when(F.col("owns"), F.col("conv")).otherwise(F.col("parent")).alias("conv_id"), F.col("length").alias("depth"), F.col("conv").alias("id"))
    keys = ["conv_id", "depth"]
    strings = ends.repartitionByRange(parts, *keys, "id").sortWithinPartitions(*keys, "id").mapInArrow(tidied(_runs), "conv_id long, depth long, least long, ids string")
    return strings.repartition(parts, *keys).sortWithinPartitions(*keys, "least").mapInArrow(tidied(_hashed), "conv_id long, depth long, ends_sha256 string")


def trie_of(turns: DataFrame, scratch: Scratch, convs: DataFrame, parts: int) -> DataFrame:
    """The nodes of the trie of turns (conv, place, digest, chars); convs: all conversations, those without turns too.

    Columns as conversation_trie() gives them.
    """
    ends = turns.agg(F.max("place").alias("longest"), F.count("*").alias("n")).first()
    count = convs.agg(F.min("conv").alias("least"), F.count("*").alias("n")).first()
    longest, least = ends.longest or 0, count.least if count.n else -1
    prefixes = chained(turns, longest, scratch, "prefixes").repartition(parts, "conv", "place")
    prefixes = scratch.write(prefixes, "prefixes", buckets=(parts, "conv", "place"))
    nodes = prefixes.groupBy("digest").agg(F.min("conv").alias("conv_id"), F.min("place").alias("depth"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"))
    nodes = scratch.write(nodes.repartition(parts, "digest"), "nodes", buckets=(parts, "digest"))

    lengths = convs.join(prefixes.groupBy("conv").agg(F.max("place").alias("length")), "conv", "left").select("conv", F.coalesce("length", F.lit(0)).alias("length"))
    chains = _first_owned(lengths, prefixes, nodes, least, longest, count.n, scratch).withColumn("owns", F.col("first") <= F.col("length"))
    chains = scratch.write(chains.withColumn("depth", F.col("first") - 1), "chains")

    # What a chain has of its own: its last node is a leaf unless another chain with nodes hangs there.
    hung = chains.filter("owns and parent is not null").select(F.col("parent").alias("conv"), F.col("depth").alias("length")).groupBy("conv", "length").agg(F.count("*").alias("n"))
    saved = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    own = chains.join(hung, ["conv", "length"], "left").join(saved, "conv", "left")
    own = own.select("conv", "parent", (F.col("owns") & F.col("n").isNull()).cast("long").alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
    totals = _totals(own, count.n, scratch)

    # One row a node: its own figures, what hangs at it, and whether it begins or ends its chain.
    blank = {"n_convs": F.lit(0), "chars": F.lit(0), "hung": F.lit(0), "leaves": F.lit(0), "saved": F.lit(0), "top": F.lit(0), "last": F.lit(0), "parent": F.lit(None)}
    shape = lambda df, conv, depth, **given: df.select(F.col(conv).alias("conv_id"), F.col(depth).cast("long").alias("depth"), *(given.get(c, x).cast("long").alias(c) for c, x in blank.items()))
    one = F.lit(1)
    below = chains.filter("parent is not null").select("conv", "parent", "depth", "owns").join(totals, "conv")
    owners = chains.filter("owns")
    cells = (
        shape(nodes, "conv_id", "depth", n_convs=F.col("n_convs"), chars=F.col("chars"))
        .unionByName(shape(chains.filter("first = 0"), "conv", "first", n_convs=F.lit(count.n)))
        .unionByName(shape(below, "parent", "depth", hung=F.col("owns"), leaves=F.col("leaves"), saved=F.col("saved")))
        .unionByName(shape(owners, "conv", "first", top=one, parent=F.col("parent")))
        .unionByName(shape(owners, "conv", "length", last=one))
        .groupBy("conv_id", "depth")
        .agg(*(F.sum(c).alias(c) for c in blank))
    )
    leaf = ((F.col("last") > 0) & (F.col("hung") == 0)).cast("long")
    cells = cells.select("conv_id", "depth", "n_convs", "top", "parent", (F.col("hung") + 1 - F.col("last")).alias("n_children"), (F.col("leaves") + leaf).alias("own_leaves"), (F.col("saved") + (F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"))
    cells = running(cells, "conv_id", [F.col("depth").desc()], "_place", {"own_leaves": "n_leaves", "own_saved": "saved_tokens"}, scratch, "cells", parts)
    none = hashlib.sha256(b"").hexdigest()
    return cells.join(_ends(chains, parts), ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        F.when(F.col("top") > 0, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", rebuild: bool = True) -> DataFrame:
    """One row a node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by number, null first; those that share one go by role, then by the SHA-256 of role and
    text. Null roles and texts are empty. With rebuild, conversations first take turns from that of
    their family (rebuilt()); a conversation may have none left and is then a member of the root.
    Repeated rows are turns of their own. Rows with a null conv_id belong to no conversation and
    are left out. An empty table has no node, not even a root. Texts are read whole, of any length, once;
    a conversation may have any number of turns. Other columns are not read.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    parts = parts_for(turns.sparkSession, turns.count() * ROW_BYTES)
    placed = placed_turns(turns, conv_col, turn_col, role_col, text_col, scratch, parts)
    convs = scratch.write(placed.select("conv").distinct(), "convs")
    turns = placed.select("conv", "place", "digest", "chars")
    if rebuild:
        turns = rebuilt(turns, scratch, parts)
    out = scratch.write(trie_of(turns, scratch, convs, parts), "nodes-out")
    for name in ("placed", "rebuilt", "prefixes", "nodes", "cells", "chains", "convs"):
        scratch.drop(name)
    return out
