"""Rendezvous hashing of stable record keys over weighted shards.

Shard ``s`` of weight ``w_s`` scores a key with ``-ln(u) / w_s``, where ``u`` in (0, 1)
comes from a 64-bit hash of (key, s); the lowest score wins, ties go to the lower shard.
A shard's scores do not depend on the other shards, so one more shard takes rows only
into itself, and a removed one gives up only its own rows.

Everything is DataFrame expressions. Slots (0, 1, 2, ... within each shard) come from a
two-level count: a window inside small hash groups plus the running total of the group
counts, so no task ever holds a whole shard.

Defined cases: a null key is hashed as its own key (the hash of shard alone); a null text
has zero bytes and the CRC-32 of the empty string; repeated rows get one slot each; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 8
#: Rows numbered together in one window group, on average.
GROUP_ROWS = 10_000


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0-based int) that wins ``key``; weights must be positive."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = []
    for s, w in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(s).cast("long")), 11)
        u = (bits.cast("double") + 0.5) / F.lit(2.0**53)
        scores.append(F.struct((-F.log(u) / F.lit(float(w))).alias("score"), F.lit(s).alias("shard")))
    if len(scores) == 1:
        return F.lit(0)
    return F.least(*scores)["shard"]


def with_slots(df: DataFrame, key: str, shard: str = "shard", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each shard, gapless, without a whole-shard sort.

    ``df`` is read twice: once for the group counts, once for the rows.
    """
    rows = df.count()
    shards = SHARDS
    groups = max(1, math.ceil(rows / (group_rows * shards)))
    grouped = df.withColumn("_group", F.pmod(F.xxhash64(F.col(key), F.lit("slot")), F.lit(groups)).cast("int"))
    before = (
        grouped.groupBy(shard, "_group")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.sum("_n").over(Window.partitionBy(shard).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select(shard, "_group", F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    order = [F.col(c) for c in df.columns if c != shard]
    numbered = grouped.withColumn(
        "_at", F.row_number().over(Window.partitionBy(shard, "_group").orderBy(F.col(key), *order)) - 1
    )
    return (
        numbered.join(before, [shard, "_group"])
        .withColumn("slot", (F.col("_before") + F.col("_at")).cast("long"))
        .drop("_group", "_before", "_at")
    )


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown_weight: float = 1.0) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``grown_shard`` is the shard after one more shard of ``grown_weight`` joins.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    placed = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        rendezvous(F.col("doc_id"), weights).cast("int").alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, grown_weight]).cast("int").alias("grown_shard"),
    )
    return with_slots(placed, "doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
