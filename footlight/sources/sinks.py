"""Writers.  Every one writes in parallel; an ordered result keeps its order across the numbered part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header line in every part."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_lines(df: DataFrame, path: str, column: str = "prediction", order: list[str] | None = None) -> None:
    """One line of text per row.  ``order`` sorts globally first, so the parts read in name order give the whole order."""
    lines = df.orderBy(*order) if order else df
    lines.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, path: str) -> None:
    """One JSON document per row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
