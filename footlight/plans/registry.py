"""Registry of checked queries: a Spark function per name, with an independent SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` is the twin to compare it with."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Nullable whole numbers are compared as doubles: engines hand them to pandas in different types."""
    return df.withColumns({c: df[c].cast("double") for c in columns})
