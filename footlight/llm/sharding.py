"""Shards of nearly equal bytes by sampled splitters.

Rows are ordered by a digest of their text, then of their id, so equal texts lie together.  The order is cut like this:

1. A sample of keys, each row's chance in proportion to its size, is drawn; its quantiles are splitters, and a key drawn
   several times becomes a range of its own.
2. Rows are partitioned into these ranges.  A range with more than twice its share is subdivided: by the digest of the id
   where it is a single heavy text, by the digest of the text elsewhere.  Rows of a heavy text that have no id are alike: they are
   dealt to as many cells as they come.
3. Exact sums over the resulting cells (a few per splitter) give every row its place in the whole order, and with it
   its shard: where the middle of its group of equal texts falls.  A group above ``GROUP_SHARE`` of a shard is dealt row by
   row, so one group cannot overfill a shard.

The sample decides how the work is split, never the result.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footlight.session import materialise

# Groups of equal texts up to 1/GROUP_SHARE of a shard stay whole.
GROUP_SHARE = 64
# Keys drawn per range, and ranges per shuffle partition.
SAMPLE, RANGES = 32, 4


def _splitters(rows: DataFrame, ranges: int, total: int) -> list[float]:
    """Quantiles of a size-weighted sample of about ``SAMPLE`` keys per range, sorted; the sample is bounded by that."""
    chance = F.col("size") * F.lit(float(SAMPLE * ranges)) / F.lit(float(max(total, 1)))
    u = F.pmod(F.xxhash64("place", F.lit("draw")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    keys = sorted(r[0] for r in rows.where(u < chance).select("number").collect())
    picked = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if len(keys) >= ranges else keys
    heavy = {a for a, b in zip(picked, picked[1:]) if a == b}
    return sorted({*picked, *[k + 1 for k in heavy]})


def assign_shards(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text", ranges: int | None = None
) -> DataFrame:
    """(<id>, size, text_crc32, shard, slot) for every row: ``size`` is the bytes of the whole text plus 1 (null: 1).

    Shards are 0 to ``shards - 1``; slots count from 0 in each without gaps.  Null texts are a group like equal texts, with
    a null checksum.  Rows that repeat an id count each.
    """
    text = F.col(text_column).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    digest = F.coalesce(F.md5(text.cast("binary")), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"),
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        digest.alias("key"),
        F.coalesce(F.md5(F.col(id_column).cast("string").cast("binary")), F.lit("")).alias("place"),
    )
    # 52 bits of the digest are a whole number that a double holds exactly; null texts come first.
    number = F.coalesce(F.conv(F.substring("key", 1, 13), 16, 10).cast("double"), F.lit(-1.0))
    rows = materialise(rows.withColumns({"number": number, "salt": F.monotonically_increasing_id()}), "keyed")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = ranges or RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    cuts = _splitters(rows, ranges, total)
    # At most shards * GROUP_SHARE groups are that large.
    heavy = rows.groupBy("key").agg(F.sum("size").alias("group_size"))
    heavy = materialise(heavy.where(F.col("group_size") * F.lit(shards * GROUP_SHARE) > F.lit(total)), "heavy_groups")
    if cuts:
        splits = [-math.inf, *cuts, math.inf]
        rows = Bucketizer(inputCol="number", outputCol="range", splits=splits).transform(rows)
    else:
        rows = rows.withColumn("range", F.lit(0.0))
    rows = rows.join(F.broadcast(heavy.select("key", F.lit(True).alias("heavy"))), "key", "left")
    rows = rows.withColumn("heavy", F.coalesce("heavy", F.lit(False)))

    # A heavy text is a range of its own within its range: before it, itself, behind it.
    nearest = rows.where("heavy").groupBy("range").agg(F.sort_array(F.collect_set("key")).alias("heavies"))
    rows = rows.join(F.broadcast(nearest), "range", "left")
    below = F.size(F.filter("heavies", lambda k: k < F.col("key")))
    layer = F.when(F.col("heavies").isNull(), 0).otherwise(2 * below + F.col("heavy").cast("int"))
    rows = rows.withColumn("layer", layer).drop("heavies")
    spans = rows.groupBy("range", "layer").agg(
        F.sum("size").alias("bytes"), F.min("number").alias("low"), F.max("number").alias("high")
    )
    share = max(total // ranges, 1)
    parts = F.when(F.col("bytes") > F.lit(2 * share), F.ceil(F.col("bytes") / F.lit(share))).otherwise(1)
    # Rows of this table: at most two per splitter and heavy group.
    rows = rows.join(F.broadcast(spans.withColumn("parts", parts).drop("bytes")), ["range", "layer"])
    by_place = F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    by_key = (F.col("number") - F.col("low")) / (F.col("high") - F.col("low") + 1)
    part = F.floor(F.when(F.col("heavy"), by_place).otherwise(by_key) * F.col("parts"))
    # Rows without an id come first in their text, and which of them comes first makes no difference.
    nameless = F.col("heavy") & (F.col("place") == "")
    rows = rows.withColumns(
        {
            "part": F.when(nameless, F.lit(-1).cast("long")).otherwise(part),
            "deal": F.when(nameless, F.pmod(F.xxhash64("salt"), F.col("parts").cast("long"))).otherwise(0),
        }
    )
    rows = rows.drop("low", "high", "parts", "salt")
    rows = materialise(rows, "cells")

    cell = ["range", "layer", "part", "deal"]
    sums = rows.groupBy(*cell).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*cell, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "rows")])
    inside = Window.partitionBy(*cell).orderBy("key", "place", "id")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy(*cell, "key")
    placed = rows.withColumns({"end": F.sum("size").over(running), "at": F.row_number().over(inside)})
    placed = placed.withColumns({"group_end": F.max("end").over(group), "group_size": F.sum("size").over(group)})
    placed = placed.join(F.broadcast(offsets), cell)
    middle = F.when(F.col("heavy"), 2 * F.col("end") - F.col("size")).otherwise(2 * F.col("group_end") - F.col("group_size"))
    twice = 2 * F.col("bytes_before") + middle
    shard = F.expr("least(cast(wide * {0} div {1} as int), {2})".format(shards, 2 * max(total, 1), shards - 1))
    placed = placed.withColumn("wide", twice).withColumn("shard", shard).withColumn("order", F.col("rows_before") + F.col("at"))
    placed = materialise(placed.select("id", "size", "text_crc32", "shard", "order"), "placed")
    first = placed.groupBy("shard").agg(F.min("order").alias("first"))  # one row per shard
    out = placed.join(F.broadcast(first), "shard")
    return out.select(F.col("id").alias(id_column), "size", "text_crc32", "shard", (F.col("order") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_column: str = "doc_id") -> None:
    """Write ``docs`` (unique ids) as a folder per shard, rows in slot order."""
    placed = docs.join(assigned.select(id_column, "shard", "slot"), id_column)
    placed = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").parquet(path)
