"""Joining a large table to a one-row-per-key table when some keys are hot."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table of at most this estimated size is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 64 << 20
# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1000
SALTS = 256


def estimated_bytes(table: DataFrame) -> int:
    """Size of a written table in memory: the real lengths of its strings and 16 bytes for every other cell."""
    strings = [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = F.count(F.lit(1)) * F.lit(16 * (len(table.columns) + 1))
    row = table.agg(*[e.alias(f"b{i}") for i, e in enumerate([fixed, *[F.sum(F.octet_length(c)) for c in strings]])]).first()
    return sum(v or 0 for v in row)


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str | None = None,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Join ``facts`` to ``table`` (one row per key, already written, see ``session.materialise``).

    * A small table, measured first, is broadcast: the facts are not shuffled at all.
    * A large one is shuffled.  ``weight`` names its column with the number of fact rows per key; hot keys
      (fewer than ``hot_share`` of them, whatever the data) are broadcast, and their fact rows are spread
      over salts, as are rows without a key, so no shuffle partition receives a hot key.
    """
    if estimated_bytes(table) <= broadcast_bytes:
        return facts.join(F.broadcast(table), keys, how)
    if weight is None:
        return facts.join(table, keys, how)

    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = table.where(F.col(weight) * F.lit(hot_share) > F.lit(total))
    values = [c for c in table.columns if c not in keys]
    hot_side = hot.select(*keys, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    absent = reduce(or_, [F.col(k).isNull() for k in keys])
    salt = F.when(F.col("_hot") | absent, F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int") + 1).otherwise(0)
    marked = facts.join(F.broadcast(hot_side), keys, "left").withColumn("_salt", salt)
    cold = table.where(F.col(weight) * F.lit(hot_share) <= F.lit(total))
    cold = cold.select(*keys, F.lit(0).alias("_salt"), F.lit(True).alias("_cold"), *values)
    joined = marked.join(cold, [*keys, "_salt"], "left")
    if how == "inner":
        joined = joined.where(F.col("_hot") | F.col("_cold"))
    return joined.select(
        *facts.columns,
        *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in values],
    )
