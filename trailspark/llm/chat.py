"""Chat formatting with cumulative-snapshot collapse.

A logged conversation that grew over time often stands in the log several
times, each snapshot a prefix of a later one. Every turn gets two 64-bit
rolling hashes over its conversation's turns up to it (exclusive or of the
hashes of place, role and text). A conversation whose last hash is an inner
turn's hash of another one is a prefix of it and falls to an anti-join; of
equal conversations the one with the least id stays. The maximal conversations
are rendered.

Prefix hashes are made distinct before they are moved to the join, so a first
turn or whole conversation that a third of the log shares is one row a task.
A conversation is rendered into one row, so its turns meet in one place; no
more than one conversation does.

Defined results: turns of a null conversation id belong to no conversation and
are left out; turns go by number (null last), ties by role and text; a null
role or text renders as ""; repeated turns stay repeated; an empty table gives
an empty result; input columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def hashed_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, place, n, role, text, h1, h2)``: turns with the hashes of their prefixes."""
    rows = turns.select(
        turns[f"`{conv_id}`"].alias("conv_id"), turns[f"`{turn}`"].alias("turn"),
        F.coalesce(turns[f"`{role}`"], F.lit("")).alias("role"),
        F.coalesce(turns[f"`{text}`"], F.lit("")).alias("text"),
    ).where("conv_id is not null")
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("place", F.row_number().over(order))
    hashes = {f"h{k}": F.bit_xor(F.xxhash64(F.lit(k), "place", "role", "text")).over(upto)
              for k in (1, 2)}
    return placed.withColumns(hashes).withColumn("n", F.count("*").over(whole))


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv_id, n, copies)`` of the conversations that prefix no other."""
    key = ["place", "h1", "h2"]
    ends = (turns.where("place = n").groupBy(*key)
            .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    inner = turns.where("place < n").select(*key).distinct()
    return ends.join(inner, key, "left_anti").select(
        "conv_id", F.col("place").alias("n"), "copies")


def chats(log: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """One row per maximal conversation: ``conv_id, n_turns, copies, chat``."""
    turns = hashed_turns(log, conv_id, turn, role, text)
    kept = maximal(turns).select("conv_id", "copies")
    line = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n"))
    rendered = turns.join(kept, "conv_id").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"),
        F.min("copies").alias("copies"))
    return rendered.select(
        "conv_id", F.size("lines").cast("long").alias("n_turns"), "copies",
        F.array_join(F.col("lines.line"), "").alias("chat"))
