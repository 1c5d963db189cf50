"""Scores of documents under a language model that is trained on the training documents.

1. Words of all training documents are counted; the most frequent MODELLED become symbols of the
   network, all others share one symbol, within which a word's share is its count's.
2. Every text becomes its symbols, 16 bits each, once. Of its other words, those that are frequent in training (up to LOOKED_UP)
   find their counts in a table that each task has; only the rest is dealt out and joined with its counts.
3. Training goes in ROUNDS over disjoint parts of the training documents. In a round each task learns
   from its own texts, starting from the model of the round before; the mean of the tasks' models, weighted
   by tokens, is the next one. Means are taken by blocks of parameters, in as many tasks.
4. Each text is scored by the final model from its first token to its end, state carried throughout.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, by_size, parts_for, tidied
from .gru import END, RARE, Model, learn, scores

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Words that are symbols of their own; classes of the output.
MODELLED, CLASSES = 4096, 64
#: Words whose counts each task has, at most; about 150 bytes each in a Python worker.
LOOKED_UP = 100_000
#: Bytes of texts whose words are looked up at once.
SLICE = 8 << 20
#: Parts of the training documents, each learnt from once; parameters of a block.
ROUNDS, BLOCK = 6, 1 << 16
#: Distinct words that a task holds before it sends their counts; tokens that are learnt from or scored at once.
HELD_WORDS, AT_ONCE = 400_000, 1 << 22
LN10 = math.log(10)


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether a document is kept from training: crc32 of its decimal id, modulo folds. A null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of lower-cased texts with their counts in this task."""

    def out(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    held: Counter[bytes] = Counter()
    for batch in batches:
        for body in batch.column("body"):
            held.update(body.as_py().translate(LOWER).split())
            if len(held) >= HELD_WORDS:
                yield out(held)
                held = Counter()
    yield out(held)


def _words(bodies: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, end to end, and how many the texts before each and all have. Only ASCII bytes are looked at."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(bodies.view(pa.string())))
    words = lists.flatten()
    full = pc.not_equal(pc.binary_length(words), 0)
    ends = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
    return words.filter(full), ends[np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]]


def _frequencies(counts: DataFrame) -> tuple[int, int, float]:
    """Words, their tokens, and the count from which on at most LOOKED_UP words have it; counts go in steps of an eighth of a power of two."""
    step = F.floor(F.log2("c") * 8)
    rows = counts.groupBy(step.alias("step")).agg(F.count("*").alias("v"), F.sum("c").alias("n"), F.min("c").alias("least")).orderBy(F.col("step").desc()).collect()
    words, least = 0, math.inf
    for r in rows:
        words += r.v
        if words > LOOKED_UP:
            break
        least = r.least
    return sum(r.v for r in rows), sum(r.n for r in rows), least


def _encode(known: Broadcast):
    """Of each text its size and symbols, sums of log10(count + 1) over symbols and over the other words in `known`, how many
    tokens are no symbols and how many are in `known`, and all words that are not, with their counts in the text.

    known: a number for each word, symbols first, the number of symbols, and log10(count + 1) by number. RARE stands for words that are not there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, n_symbols, logs = known.value
        names = pa.array(list(number), pa.binary()).view(pa.string())
        for batch in batches:
            for part in by_size(batch, SLICE, 3):
                words, ends = _words(part.column("body"))
                n = part.num_rows
                doc = np.repeat(np.arange(n), np.diff(ends))
                ids = pc.fill_null(pc.index_in(words, value_set=names), RARE - 2).to_numpy() + 2
                unknown, others = ids == RARE, ids >= n_symbols
                weights = logs[ids]
                other_logs = np.bincount(doc[others], weights=weights[others], minlength=n)
                symbol_logs = np.bincount(doc[~others], weights=weights[~others], minlength=n) + logs[END]
                n_unknown = np.bincount(doc[unknown], minlength=n)
                n_rare = n_unknown + np.bincount(doc[others], minlength=n)
                # Each unknown word of a text once.
                coded = words.filter(pa.array(unknown)).dictionary_encode()
                pairs, counts = np.unique(doc[unknown] * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
                of, code = np.divmod(pairs, max(1, len(coded.dictionary)))
                struct = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(code)).view(pa.binary()), pa.array(counts, pa.int32())], names=["word", "n"])
                rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()), struct)
                ids[others] = RARE
                symbols = np.insert(ids.astype(np.uint16), ends[1:], END)
                places = ends + np.arange(n + 1)
                data = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((2 * places).astype(np.int32)), pa.py_buffer(symbols)])
                size = np.diff(places)
                numbers = (pa.array(size, pa.int64()), data, pa.array(symbol_logs, pa.float64()), pa.array(other_logs, pa.float64()), pa.array(n_rare, pa.int64()), pa.array(size - n_unknown, pa.int64()))
                columns = [*(part.column(c) for c in ("row", "doc_id", "held_out")), *numbers, rare]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "held_out", "n_tokens", "symbols", "logs", "other_logs", "n_rare", "n_known", "rare"])

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Rows and symbols of texts, about AT_ONCE tokens at a time."""
    rows, some, size = [], [], 0
    for batch in batches:
        for row, data in zip(batch.column("row").to_pylist(), batch.column("symbols")):
            rows.append(row)
            some.append(np.frombuffer(data.as_py(), dtype=np.uint16).astype(np.int32))
            size += len(some[-1])
            if size >= AT_ONCE:
                yield rows, some
                rows, some, size = [], [], 0
    if some:
        yield rows, some


def _learn(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, flat = model.value
        own, tokens = shape.filled(flat), 0
        for _, texts in _texts(batches):
            tokens += learn(own, texts)
        if tokens:
            flat = own.flat()
            blocks = [flat[k : k + BLOCK].tobytes() for k in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array([tokens] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())], names=["block", "tokens", "data"])

    return run


def _mean(frame: pd.DataFrame) -> pd.DataFrame:
    """The mean of a block over all tasks, weighted by tokens."""
    total, weight = 0.0, 0
    for tokens, data in zip(frame["tokens"], frame["data"]):
        total = total + np.frombuffer(data, dtype=np.float32).astype(np.float64) * tokens
        weight += tokens
    return pd.DataFrame({"block": frame["block"].iloc[:1], "data": [(total / weight).astype(np.float32).tobytes()]})


def train(texts: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """The model after learning from texts (row, symbols), each once. Only models, of fixed size, come to the driver."""
    spark = texts.sparkSession
    for k in range(rounds):
        part = texts.filter(F.pmod(F.xxhash64("row"), F.lit(rounds)) == k).select("row", "symbols")
        sent = spark.sparkContext.broadcast((model, model.flat()))
        found = part.mapInArrow(tidied(_learn(sent)), "block int, tokens long, data binary").groupBy("block").applyInPandas(_mean, "block int, data binary").collect()
        if found:
            model = model.filled(np.concatenate([np.frombuffer(r.data, dtype=np.float32) for r in sorted(found, key=lambda r: r.block)]))
        sent.unpersist()
    return model


def _score(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(scores(model.value, texts) / LN10)], names=["row", "log10"])

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    Tokens are the blank-separated words, A-Z lower-cased, and one end. base_score adds up
    log10((c + 1) / (N + V + 1)) of counts c among N training tokens, V of them distinct. score is the log10 probability
    of the text under the network: of the next symbol given all before, and for a word that is no
    symbol times (c + 1) / (n + v + 1), n and v being tokens and distinct words of that kind in training;
    all words that training never had share one place, as in base_score.

    Null texts are empty: their end is scored. Null ids count as an empty text in the choice of held-out rows. Rows that repeat
    are texts of their own. Without training documents N and V are 0. An empty table gives no rows. Texts are
    scored whole, of any length. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    counts = rows.filter("not held_out").select("body").mapInArrow(tidied(_count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    counts = scratch.write(counts, "counts")
    n_train = rows.filter("not held_out").count()
    v_all, n_all, least = _frequencies(counts)
    top = counts.orderBy(F.col("c").desc(), "word").limit(MODELLED).collect()
    modelled = sum(r.c for r in top)
    n_tokens, n_distinct = n_all + n_train, v_all + (n_train > 0)
    n_rare, v_rare = n_all - modelled, v_all - len(top)

    frequency = np.array([n_rare, n_train, *(r.c for r in top)], dtype=np.int64)
    number = {bytes(r.word): k + 2 for k, r in enumerate(top)}
    known_counts = frequency.tolist()
    for r in counts.filter(F.col("c") >= least).collect():
        if number.setdefault(bytes(r.word), len(known_counts)) == len(known_counts):
            known_counts.append(r.c)
    logs = np.log10(np.array(known_counts) + 1.0)
    logs[RARE] = 0
    known = spark.sparkContext.broadcast((number, len(frequency), logs))
    encoded = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "body").mapInArrow(
        tidied(_encode(known)), "row long, doc_id long, held_out boolean, n_tokens long, symbols binary, logs double, other_logs double, n_rare long, n_known long, rare array<struct<word:binary,n:int>>"
    )
    encoded = scratch.write(encoded, "encoded")

    # Words that no task has the counts of: one sum a text.
    rare = encoded.select("row", F.explode("rare").alias("w")).select("row", "w.word", "w.n")
    parts = parts_for(spark, 4 * scratch.size("encoded"))
    found = rare.repartition(parts, "word").join(counts.hint("shuffle_hash"), "word")
    sums = found.groupBy("row").agg(F.sum("n").alias("n_rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_logs"))
    sums = scratch.write(sums, "sums")

    model = train(encoded.filter("not held_out"), Model.new(frequency, CLASSES))
    final = spark.sparkContext.broadcast(model)
    scored = encoded.select("row", "symbols").mapInArrow(tidied(_score(final)), "row long, log10 double")
    n = lambda c: F.coalesce(c, F.lit(0))
    out = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_rare", "n_known", "logs", "other_logs").join(scored, "row").join(sums, "row", "left")
    rare_logs = F.col("other_logs") + n("rare_logs")
    out = out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + n("n_rare_known") - int(n_train == 0)).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + rare_logs - F.col("n_tokens") * math.log10(n_tokens + n_distinct + 1)).alias("base_score"),
        (F.col("log10") + rare_logs - F.col("n_rare") * math.log10(n_rare + v_rare + 1)).alias("score"),
    )
    out = scratch.write(out, "out")
    for name in ("counts", "encoded", "sums"):
        scratch.drop(name)
    return out
