"""Vocabularies of categorical columns and their application."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.functions.text import UNKNOWN, category_key
from footlight.operators.ordering import sorted_positions
from footlight.operators.skew import lookup_join
from footlight.session import materialise


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n) of the non-null values."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def collapse_rare(df: DataFrame, column: str, min_frequency: int) -> DataFrame:
    """Values seen fewer than ``min_frequency`` times become 'unknown'; nulls stay."""
    rare = (F.col("n") < min_frequency).alias("_rare")
    counts = value_counts(df, column).select(F.col("value").alias(column), rare, F.col("n").alias("_rows"))
    marked = lookup_join(df, materialise(counts, "value_counts"), [column], weight="_rows")
    return marked.withColumn(column, F.when(F.col("_rare"), UNKNOWN).otherwise(F.col(column))).select(*df.columns)


def fit_vocabulary(df: DataFrame, column: str, min_frequency: int = 0) -> DataFrame:
    """(column, value, code, n): sorted known values; 'unknown' is always known and comes last unless it occurs itself."""
    counts = value_counts(df, column)
    kept = F.when(F.col("n") < min_frequency, UNKNOWN).otherwise(F.col("value"))
    counts = counts.groupBy(kept.alias("value")).agg(F.sum("n").alias("n"))
    coded = sorted_positions(counts, "value")
    last = coded.agg(
        (F.coalesce(F.max("code"), F.lit(-1)) + 1).cast("int").alias("code"),
        F.coalesce(F.bool_or(F.col("value") == UNKNOWN), F.lit(False)).alias("listed"),
    )
    extra = last.where(~F.col("listed")).select(F.lit(UNKNOWN).alias("value"), F.lit(0).cast("long").alias("n"), "code")
    return coded.select("value", "n", "code").unionByName(extra).select(F.lit(column).alias("column"), "value", "code", "n")


def _entries(vocabulary: DataFrame, column: str) -> DataFrame:
    own = vocabulary.where(F.col("column") == column)
    return own.select(F.col("value").alias(column), F.col("code").alias("_code"), *([F.col("n").alias("_rows")] if "n" in own.columns else []))


def apply_vocabulary(df: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """Values outside the vocabulary become 'unknown'."""
    known = materialise(_entries(vocabulary, column), "known_values")
    marked = lookup_join(df, known, [column], weight="_rows").withColumn(
        column, F.when(F.col("_code").isNotNull(), F.col(column)).otherwise(UNKNOWN)
    )
    return marked.select(*df.columns)


def unseen_values(df: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """(value, n): values outside the vocabulary with their row counts.  Only distinct values meet the vocabulary."""
    known = vocabulary.where(F.col("column") == column).select("value")
    return value_counts(df, column).join(known, "value", "left_anti")


def normalise_category(
    df: DataFrame, column: str, vocabulary: DataFrame | None = None, min_frequency: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Fingerprint a categorical column and fit (no ``vocabulary``) or apply one; returns (frame, vocabulary)."""
    keyed = df.withColumn(column, category_key(F.col(column)))
    if vocabulary is not None:
        return apply_vocabulary(keyed, column, vocabulary), vocabulary
    fitted = fit_vocabulary(keyed, column, min_frequency)
    return (collapse_rare(keyed, column, min_frequency) if min_frequency > 0 else keyed), fitted


def category_codes(df: DataFrame, column: str, output: str, source: DataFrame | None = None) -> DataFrame:
    """Position of each value among the sorted distinct values; null gets -1.

    ``source`` gives the table to take the values from when ``df`` is a longer way to the same column.
    """
    codes = sorted_positions(value_counts(df if source is None else source, column), "value")
    table = materialise(codes.select(F.col("value").alias(column), F.col("code").alias(output), F.col("n").alias("_rows")), "codes")
    coded = lookup_join(df, table, [column], weight="_rows")
    return coded.withColumn(output, F.coalesce(output, F.lit(-1)).cast("int")).drop("_rows")


def apply_category_map(df: DataFrame, columns: list[str], mapping: DataFrame, fill: str = "Unknown") -> DataFrame:
    """Add ``<column>_code`` from a saved (column, value, code) map; a value outside the map has a null code."""
    out = df
    for c in columns:
        filled = out.withColumn(c, F.coalesce(F.col(c), F.lit(fill)))
        entries = _entries(mapping.drop("n"), c)
        # Hot keys are those of the table to be coded, not of the one that the map was fitted on.
        seen = value_counts(filled, c).select(F.col("value").alias(c), F.col("n").alias("_rows"))
        entries = materialise(entries.join(seen, c), "category_map")
        out = lookup_join(filled, entries, [c], weight="_rows").drop("_rows").withColumnRenamed("_code", f"{c}_code")
    return out
