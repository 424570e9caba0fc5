"""Weighted rendezvous hashing of record keys over shards, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import stage

#: rows numbered together; a shard's rows beyond it go to further pieces
ROWS_PER_PIECE = 20_000


def _score(key: Column, shard: int, weight: float) -> Column:
    """An exponential variable of rate ``weight``: the shard with the smallest one wins a key."""
    digits = F.substring(F.md5(F.concat_ws(":", key, F.lit(str(shard)))), 1, 13)
    # 52 bits, so that the number and its sum with one half are exact doubles
    return -F.ln((F.conv(digits, 16, 10).cast("double") + 0.5) / 2.0**52) / F.lit(float(weight))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of a key, 0 to ``len(weights) - 1``; one more weight takes keys only into the new shard.

    A shard's expected part of the keys is its weight's part of all weights. Weights of
    zero or less get nothing; at least one must be positive.
    """
    bids = [F.struct(_score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights) if w > 0]
    if not bids:
        raise ValueError("no shard has a weight above zero")
    return F.array_min(F.array(*bids))["shard"]


def shard_rows(
    docs: DataFrame,
    weights: list[float],
    grown_weight: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """(id_col, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    ``shard`` depends on the key and the weights alone. ``grown_shard`` is the key's shard
    after one more shard of ``grown_weight`` has joined: the old shard or the new one.
    ``size`` is 8 more than the text's UTF-8 bytes. ``slot`` numbers a shard's rows from 0
    without gaps in the order of key, checksum and size: rows are dealt over ranges of that
    order, numbered within each range, and shifted by the rows of the ranges before.

    A null text has no bytes and the checksum 0. Rows of one key, null included, share a
    shard and get slots of their own. An empty table gives an empty table; other columns
    are not read.
    """
    key, text = F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, grown_weight]).alias("grown_shard"),
    )
    rows = stage(rows, "shards")
    order = ["id", "text_crc32", "size"]
    pieces = max(1, -(-rows.count() // (len(weights) * rows_per_piece)))
    if pieces > 1:
        # ranges of keys in order; equal keys are told apart by their texts, so they need not meet
        ranged = rows.repartitionByRange(pieces, *order).withColumn("piece", F.spark_partition_id())
        rows = stage(ranged, "shard-pieces")
    else:
        rows = rows.withColumn("piece", F.lit(0))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        rows.groupBy("shard", "piece")
        .agg(F.count("*").alias("n"))
        .select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    within = Window.partitionBy("shard", "piece").orderBy(*order)
    return rows.join(shifts, ["shard", "piece"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("shift") + F.row_number().over(within) - 1).alias("slot"),
        "grown_shard",
    )
