"""Chat formatting after cumulative snapshots are collapsed.

Chat logs often store a conversation again after every turn. A rolling hash over the turns gives every prefix of every
conversation a 128 bit value: turn i adds the hash of (i, role, text) to the value of the prefix before it. A
conversation whose whole value is the value of a shorter prefix of another one is such a snapshot and goes (anti join);
of equal conversations the one with the smallest id stays. What remains is rendered turn by turn between markers.

Defined results: turns are ordered by turn number, then role, then text, nulls first; gaps in the numbers do not matter; a
repeated row of a conversation counts once; rows without a conversation id belong to no conversation and go; a null
role or text is rendered as empty but is not equal to an empty one; extra columns are not read. Markers inside a text are kept
as they are if `escape` is off, else their first `<` is followed by a zero-width space.

Scale: a conversation need not be in one task, whatever its turn numbers. Turns are put in order by one range partitioned
sort over all conversations; a turn's place is its place in the sort less that of the conversation's first turn. As adding is
associative, hashes are summed inside blocks of `BLOCK` places and then over blocks, and rendering gives one row (part) per
block. Prefix values are made distinct by a partially aggregated group-by before they meet, so a snapshot logged by a third of all rows is one
row per task; the anti join is an equi join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from govpub.llm.base import staged
from govpub.llm.resample import numbered

#: Turns of a block and so of a rendered part.
BLOCK = 1024
START, END = "<|im_start|>", "<|im_end|>"


def positions(turns: DataFrame) -> DataFrame:
    """conv_id, block, pos (from 1), role, text: every distinct turn with its place in the conversation."""
    distinct = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text").distinct()
    placed = numbered(distinct, [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")], "place", "turn-order")
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    pos = F.col("place") - F.col("first") + 1
    return placed.join(first, "conv_id").select(
        "conv_id", F.floor((pos - 1) / BLOCK).alias("block"), pos.alias("pos"), "role", "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, pos, h, g: the rolling hash of the first `pos` turns."""
    empty = [F.col(c).isNull() for c in ("role", "text")]
    hashed = turns.select("conv_id", "block", "pos", F.xxhash64("pos", "role", "text", *empty).alias("h0"),
                          F.xxhash64(F.lit("g"), "pos", "role", "text", *empty).alias("g0"))
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.select("conv_id", "block", "pos", F.bit_xor("h0").over(inside).alias("h1"),
                           F.bit_xor("g0").over(inside).alias("g1"))
    total = hashed.groupBy("conv_id", "block").agg(F.bit_xor("h0").alias("ht"), F.bit_xor("g0").alias("gt"))
    order = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = total.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"),
                          F.bit_xor("ht").over(order).alias("hb"), F.bit_xor("gt").over(order).alias("gb"))
    zero = F.lit(0).cast("long")
    return rolled.join(before, (F.col("conv_id") == F.col("_c")) & (F.col("block") == F.col("_b"))).select(
        "conv_id", "pos", F.col("h1").bitwiseXOR(F.coalesce("hb", zero)).alias("h"),
        F.col("g1").bitwiseXOR(F.coalesce("gb", zero)).alias("g"))


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns of the conversations that prefix no longer one; the smallest id of equal ones."""
    last = prefixes.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
    ended = prefixes.join(last, "conv_id")
    whole = ended.where("pos = n_turns").groupBy("h", "g", "pos").agg(F.min("conv_id").alias("conv_id"))
    proper = ended.where("pos < n_turns").select("h", "g", "pos").distinct()
    return whole.join(proper, ["h", "g", "pos"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"))


def rendered(turns: DataFrame, escape: bool = True) -> DataFrame:
    """conv_id, part (from 0), n_turns of the whole conversation, text of the part."""
    placed = staged(positions(turns), "turns")
    kept = maximal(staged(prefix_hashes(placed), "prefixes"))
    body = F.coalesce("text", F.lit(""))
    if escape:
        for mark in (START, END):
            body = F.replace(body, F.lit(mark), F.lit(mark[0] + "​" + mark[1:]))
    one = F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit("\n"), body, F.lit(END + "\n"))
    rows = placed.join(kept, "conv_id").select("conv_id", "block", "n_turns", F.struct("pos", one.alias("t")).alias("o"))
    return rows.groupBy("conv_id", "block", "n_turns").agg(F.array_sort(F.collect_list("o")).alias("o")).select(
        "conv_id", F.col("block").cast("long").alias("part"), F.col("n_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("o", lambda x: x["t"]), "").alias("text"))
