"""Chat formatting after cumulative-snapshot collapse.

Loggers that write a conversation after every turn leave each prefix of it as a conversation of its
own. A turn's hash covers its place, role and text; the running hash of a conversation's first k
turns combines these. A conversation whose whole hash is the running hash of a longer one is a
prefix of it and goes, by anti-join; of equal conversations the one with the smallest id stays. Only
what stays is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Marks around a turn in the rendered text.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def maximal_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns with their place, the conversations that stay).

    Running hashes are the exclusive or of two 64-bit hashes per turn, with a start of their own each,
    of the SHA-256 digest of (place, role, text): the order of turns counts, and different turns are
    not taken for one, by chance or by design. What goes from a conversation to the joins is 16 bytes a turn.
    Prefixes are first brought to one row each with the longest conversation that has it: a first
    turn that a third of all conversations share is one row then.
    """
    scratch = Scratch(turns.sparkSession, "chat")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("place", F.row_number().over(order))
    placed = scratch.write(placed, "placed")

    turn = F.sha2(F.concat_ws("|", "place", F.octet_length("role"), "role", "text"), 256)
    cell = [F.xxhash64(F.lit(k), turn) for k in (1, 2)]
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    runs = (
        placed.select("conv_id", "place", cell[0].alias("a"), cell[1].alias("b"))
        .withColumn("n", F.count("*").over(Window.partitionBy("conv_id")))
        .select("conv_id", "place", "n", F.expr("bit_xor(a)").over(so_far).alias("a"), F.expr("bit_xor(b)").over(so_far).alias("b"))
    )
    runs = scratch.write(runs, "runs")
    prefixes = runs.filter("place < n").select("place", "a", "b").distinct()
    ends = runs.filter("place = n").groupBy(F.col("place"), "a", "b").agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id"))["conv_id"].alias("conv_id"), F.count("*").alias("n_copies"))
    return placed, ends.join(prefixes, ["place", "a", "b"], "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_copies")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, n_turns, n_copies (logged conversations equal to it) and rendered of each maximal conversation.

    Turns go by turn number; those that share one go by role and text. Null roles and texts render as
    empty; turns without a number come first. All turns with a null conv_id are one conversation,
    with a null id. Repeated rows are turns of their own. An empty table gives no rows. Texts are kept whole, of any length. Other columns are not read.
    """
    placed, kept = maximal_conversations(turns, conv_col, turn_col, role_col, text_col)
    kept = kept.withColumnRenamed("conv_id", "kept_id")
    line = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"), F.col("text"), F.lit(CLOSE + "\n"))
    return (
        placed.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
        .groupBy("conv_id", "n_turns", "n_copies")
        .agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"))
        .select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies", F.array_join(F.col("lines.line"), "").alias("rendered"))
    )
