import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from quillspark.llm import queries, trie
from quillspark.llm.common import Scratch
from quillspark.llm.running import running

from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows, rebuild=True):
    """The nodes, by sets of members of each prefix."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}|{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), role, digest, text))
    turns = {c: [(role, text) for _, role, _, text in sorted(v, key=lambda x: x[:3])] for c, v in turns.items()}
    full = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        full[c] = (turns.get(c - c % 100, [])[:h] + turns[c][h:]) if h else turns[c]
    members = defaultdict(set)
    for c, t in full.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = [out[c] for c in children[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(r["saved_tokens"] for r in below)
        ends = sorted(c for c in members[node] if len(full[c]) == len(node))
        out[node] = {
            "conv_id": min(members[node]),
            "depth": len(node),
            "parent_conv_id": min(members[node[:-1]]) if node else None,
            "n_convs": len(members[node]),
            "n_children": len(below),
            "n_leaves": sum(r["n_leaves"] for r in below) or 1,
            "saved_tokens": saved,
            "ends_sha256": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        }
    return sorted((tuple(r[c] for c in COLUMNS) for r in out.values()), key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_turns(seed):
    rnd = random.Random(seed)
    stems = [[("user", f"s{k} t{d}") for d in range(rnd.randint(1, 9))] for k in range(4)]
    rows = []
    for c in range(0, 260, rnd.choice([1, 3])):
        stem = rnd.choice(stems)[: rnd.randint(0, 9)]
        talk = stem + [(rnd.choice(["user", "assistant", None]), rnd.choice(["a", "é́x", None, "", "end"])) for _ in range(rnd.randint(0, 3))]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(talk or [("user", "only")])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_sets(spark, seed):
    rows = some_turns(seed)
    assert found(trie.conversation_trie(spark.createDataFrame(rows, TURNS))) == by_hand(rows)


def test_long_and_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS", 3)
    rows = [(c, k, "user", f"t{k}") for c in (7, 9, 300) for k in range(1100)]
    rows += [(c, k, "user", f"t{k}" if k < 700 else "other") for c in (8, 5) for k in range(900)]
    # Many that are equal, and chains below chains: i shares i turns with the one before.
    rows += [(c, k, "user", "same") for c in range(1000, 1040) for k in range(3)]
    rows += [(2000 + i, k, "user", f"deep{min(k, j)}-{k}") for i in range(12) for k, j in ((k, i) for k in range(14))]
    assert found(trie.conversation_trie(spark.createDataFrame(rows, TURNS), rebuild=False)) == by_hand(rows, rebuild=False)
    assert found(trie.conversation_trie(spark.createDataFrame(rows, TURNS))) == by_hand(rows)


def test_odd_rows(spark):
    rows = [(4, None, None, None), (4, 1, "user", "a"), (4, 1, "user", "a"), (4, 0, "", ""), (4, 1, "assistant", "a"), (None, 0, "user", "gone"), (205, 0, "user", "x"), (1, 0, "user", "y" * 100_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS + ", place long, digest long")
    assert found(trie.conversation_trie(df)) == by_hand(rows)
    assert found(trie.conversation_trie(df.limit(0))) == []
    none = [(1, 0, "user", "x")]  # conversation 1 takes its first turns from 0, which isn't there
    assert zlib.crc32(b"1") % 6 > 0 and found(trie.conversation_trie(spark.createDataFrame(none, TURNS))) == by_hand(none)


def test_running_over_split_groups(spark):
    rows = [(g, k, (g * 7 + k) % 5) for g, n in ((1, 3), (2, 5000), (3, 1), (4, 2)) for k in range(n)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "g long, k long, x long")
    out = running(df, "g", [F.col("k").desc()], "place", {"x": "total"}, Scratch(spark, "running"), "t", 16)
    assert out.select(F.spark_partition_id()).distinct().count() > 1
    want, total, last = [], 0, None
    for g, k, x in sorted(rows, key=lambda r: (r[0], -r[1])):
        place, total = (1, x) if g != last else (place + 1, total + x)
        last = g
        want.append((g, k, x, place, total))
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op13_conversation_trie(spark, sf)) == by_hand(rows)
