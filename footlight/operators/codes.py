"""Category codes as a pipeline stage whose state is a table.

The labels of a text column never reach the driver: they are counted, ranked by falling frequency, and joined to the rows.  The
stage is saved with its table and loaded again like any other.
"""

from __future__ import annotations

import json

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlight.operators.categorical import value_counts
from footlight.operators.ordering import sorted_positions
from footlight.operators.skew import lookup_join
from footlight.session import materialise

# Up to so many codes a column is a set of categories for the trees; beyond that it is a number, ordered by frequency.
CATEGORIES = 256


class CategoryCodes(Model, MLWritable, MLReadable):
    """Adds ``<column>_idx`` for every column: the value's rank by falling frequency, ties by value; one code more for all others."""

    def __init__(self, columns: list[str] | None = None, sizes: list[int] | None = None, table: DataFrame | None = None):
        super().__init__()
        self.columns, self.sizes, self.table = columns or [], sizes or [], table

    def getInputCols(self) -> list[str]:
        return self.columns

    @property
    def widest(self) -> int:
        """Number of codes of the widest column that counts as categories."""
        return max((n + 1 for n in self.sizes if n < CATEGORIES), default=0)

    def _transform(self, df: DataFrame) -> DataFrame:
        for c, n in zip(self.columns, self.sizes):
            own = self.table.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias("_code"), F.col("n").alias("_rows"))
            joined = lookup_join(df, own, [c], weight="_rows")
            code = F.coalesce(F.col("_code"), F.lit(n)).cast("double")
            nominal = {"ml_attr": {"type": "nominal", "num_vals": n + 1}} if n < CATEGORIES else {}
            df = joined.withColumn(f"{c}_idx", code.alias(f"{c}_idx", metadata=nominal)).drop("_code", "_rows")
        return df

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, stage: CategoryCodes):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        state = {"state": json.dumps({"columns": self.stage.columns, "sizes": self.stage.sizes})}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=state)
        self.stage.table.write.parquet(f"{path}/codes")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> CategoryCodes:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        state = json.loads(metadata["state"])
        stage = self.kind(state["columns"], state["sizes"], self.sparkSession.read.parquet(f"{path}/codes"))
        stage._resetUid(metadata["uid"])
        return stage


def fit_codes(df: DataFrame, columns: list[str]) -> CategoryCodes:
    """Codes of the non-null values of each column; one table (column, value, code, n) holds all of them."""
    spark: SparkSession = df.sparkSession
    parts = []
    for c in columns:
        counts = value_counts(df, c).withColumn("_n", F.col("n"))
        # Text order of this key is falling frequency, then the value.
        counts = counts.withColumn("_key", F.concat(F.lpad((F.lit(10**18) - F.col("n")).cast("string"), 19, "0"), "value"))
        coded = sorted_positions(counts, "_key")
        parts.append(coded.select(F.lit(c).alias("column"), "value", "code", F.col("_n").alias("n")))
    empty = spark.createDataFrame([], "column string, value string, code int, n long")
    for part in parts:
        empty = empty.unionByName(part)
    table = materialise(empty, "category_codes")
    found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return CategoryCodes(columns, [found.get(c, 0) for c in columns], table)
