"""Reproducible stratified splits.

Rows of one class are shuffled by the MD5 of their key and numbered in that order.  MD5 is uniform, so its
leading digits cut each class into even buckets: numbering runs inside buckets and only one count per class
and bucket is ordered globally, however large a class is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 3  # 16 ** 3 = 4096 buckets per class


def _numbered(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Add ``_place`` (1-based, per class, in shuffled order) and ``_size`` (class size)."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    hashed = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, PREFIX_DIGITS))
    counts = hashed.groupBy(F.col(label).alias("_class"), "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    in_class = Window.partitionBy("_class")
    before = in_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_class",
        F.col("_bucket").alias("_part"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(in_class).alias("_size"),
    )
    # At most 4096 rows per class.
    same = F.col(label).eqNullSafe(F.col("_class")) & (F.col("_bucket") == F.col("_part"))
    joined = hashed.join(F.broadcast(offsets), same)
    inside = Window.partitionBy("_class", "_bucket").orderBy("_digest", key)
    return joined.withColumn("_place", F.col("_before") + F.row_number().over(inside)).drop("_digest", "_bucket", "_part", "_before", "_class")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 3, seed: int = 42, output: str = "fold") -> DataFrame:
    """Add a fold number 0..folds-1; every class is spread evenly to within one row."""
    numbered = _numbered(df, label, key, seed)
    return numbered.withColumn(output, ((F.col("_place") - 1) % folds).cast("int")).drop("_place", "_size")


def stratified_holdout(
    df: DataFrame, label: str, key: str, share: float = 0.15, seed: int = 42, output: str = "is_holdout"
) -> DataFrame:
    """Mark ``share`` of each class, rounded up, as hold-out."""
    numbered = _numbered(df, label, key, seed)
    limit = F.ceil(F.lit(float(share)) * F.col("_size"))
    return numbered.withColumn(output, F.col("_place") <= limit).drop("_place", "_size")
