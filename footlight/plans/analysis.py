"""Feature analysis: collinearity of the feature matrix and association of the genre with the label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footlight.operators import categorical, stats
from footlight.session import materialise
from footlight.sources import sinks

# --- Fixed values -----------------------------------------------------------
DROPPED = ["isAdult", "primaryTitle", "originalTitle", "tconst", "startYear", "endYear", "averageRating"]
GENRE = "tmdb_primary_genre"
# ----------------------------------------------------------------------------


def encode(features: DataFrame, dropped: list[str] | None = None) -> DataFrame:
    """Numeric view of the features, written once: text as category codes (null is -1), booleans as 0 and 1."""
    out = features.drop(*(DROPPED if dropped is None else dropped))
    for field in out.schema.fields:
        if isinstance(field.dataType, T.BooleanType):
            out = out.withColumn(field.name, F.col(field.name).cast("int"))
        elif isinstance(field.dataType, T.StringType):
            coded = categorical.category_codes(out, field.name, f"_{field.name}", features)
            out = coded.withColumn(field.name, F.col(f"_{field.name}")).drop(f"_{field.name}")
    return materialise(out, "encoded")


def collinearity(features: DataFrame, out_dir: str, threshold: float = stats.COLLINEAR, dropped: list[str] | None = None) -> DataFrame:
    """Write the Spearman matrix and return the collinear pairs, strongest first."""
    encoded = encode(features, dropped)
    matrix = f"{out_dir}/spearman_matrix"
    sinks.write_table(stats.spearman_matrix(encoded, encoded.columns), matrix)
    pairs = features.sparkSession.read.parquet(matrix).where(F.col("x") < F.col("y"))
    return pairs.select("x", "y", F.abs("rho").alias("strength")).where(F.col("strength") >= threshold).orderBy(F.desc("strength"), "x", "y")


def association(features: DataFrame, out_dir: str, category: str = GENRE, label: str = "label") -> DataFrame:
    """Write the contingency table and the rates of groups large enough; return the chi-squared test with Cramér's V."""
    sinks.write_table(stats.contingency(features, category, label), f"{out_dir}/contingency")
    sinks.write_table(stats.group_positive_rate(features, category, label), f"{out_dir}/group_rates")
    sinks.write_table(stats.overall_rate(features, label), f"{out_dir}/overall_rate")
    return stats.chi_squared(features, category, label)
