"""Cumulative-snapshot collapse and chat rendering (DataFrame operations only).

A logged conversation that another one continues is a prefix of it, turn by
turn.  Every turn gets a hash of the conversation up to and including it: the
exclusive-or, over the turns so far, of a hash of (place, role, text), kept
as a running aggregate.  A whole conversation's hash that also appears as a
proper prefix of another marks it as a snapshot, and an anti-join removes it.
Only the turns of conversations that stay are gathered and rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stage_table


def maximal_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                          role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation that no longer one begins with, rendered.

    Returns ``conv_id, n_turns, rendered, n_snapshots`` (other conversations
    it stands for that are copies of the whole).  Of equal conversations the
    smallest ``conv_id`` stays.  Turns go by ``turn``, then role and a digest
    of the text, so repeated turn numbers have a defined order and repeated rows stay
    repeated turns; null turns come first, null roles and texts count as
    empty.  Rows without a conversation id belong to no conversation and are
    left out.  Rendering: ``<|im_start|>role``, a new line, the text,
    ``<|im_end|>`` and a new line for each turn.

    All copies and snapshots are found on narrow rows of hashes.  The prefix
    keys are made distinct before the anti-join, so a first turn that very
    many conversations share is one row of it.
    """
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("conv_id is not null")
    # Texts do not enter the sort: their digests do.
    d = t.select("conv_id", "turn", "role", F.xxhash64("role", "text").alias("a"),
                 F.xxhash64(F.lit(1), F.md5(F.col("text").cast("binary")), "role").alias("b"))
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "b", "a")
    d = d.withColumn("place", F.row_number().over(w))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("conv_id", "place",
                 F.bit_xor(F.xxhash64("place", "a", "b")).over(run).alias("h1"),
                 F.bit_xor(F.xxhash64("b", "place", "a", F.lit(2))).over(run).alias("h2"))
    d = stage_table(d, "prefixes")
    whole = d.groupBy("conv_id").agg(F.max(F.struct("place", "h1", "h2")).alias("w"))
    whole = stage_table(whole.select("conv_id", "w.*"), "whole")
    kept = whole.groupBy("place", "h1", "h2").agg(F.min("conv_id").alias("conv_id"),
                                                  (F.count(F.lit(1)) - 1).alias("n_snapshots"))
    # Proper prefixes: every turn but the conversation's last.
    last = whole.select(F.col("conv_id").alias("_c"), F.col("place").alias("_n"))
    proper = d.join(last, (F.col("conv_id") == F.col("_c")) & (F.col("place") < F.col("_n")))
    proper = proper.select("place", "h1", "h2").distinct()
    kept = kept.join(proper, ["place", "h1", "h2"], "left_anti").select(
        "conv_id", F.col("place").alias("n_turns"), "n_snapshots")
    line = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    # Gathered in the order the places were given: the same keys sort the turns.
    body = t.join(kept.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "turn", "role", F.xxhash64(F.lit(1), F.md5(F.col("text").cast("binary")), "role").alias("b"),
            F.xxhash64("role", "text").alias("a"), line.alias("line")))).alias("turns"))
    return kept.join(body, "conv_id").select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda s: s["line"]), "").alias("rendered"),
        F.col("n_snapshots").cast("long").alias("n_snapshots"))
