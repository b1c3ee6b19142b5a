"""Training-time preparation in three phases, each with a Parquet checkpoint.

ingest -> cleaned, directing, writing, column_classes, clamp_bounds
enrich -> enriched, vocabularies
graph  -> features
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footlight.operators import enrich, graph, outliers
from footlight.session import materialise
from footlight.sources import sinks, tables


def ingest(
    spark: SparkSession, titles: str, out_dir: str, directing: str | None = None, writing: str | None = None
) -> None:
    """Read the CSV shards, clamp outliers of whole-number columns, convert the crew relations."""
    raw = tables.repair_titles(tables.read_raw_csv(spark, titles)).drop(tables.INDEX_COLUMN)
    classes = {**tables.infer_classes(raw), **({"label": "int"} if "label" in raw.columns else {})}
    sinks.write_table(tables.lost_cells(raw, classes), f"{out_dir}/lost_cells")
    # The files are parsed once more for this, and the limits are fitted on the typed columns.
    cleaned = materialise(tables.read_titles(spark, titles, "titles", classes), "typed_titles")
    bounds = outliers.fit_bounds(cleaned, multiplier=outliers.PIPELINE_MULTIPLIER)
    sinks.write_table(outliers.clamp(cleaned, bounds), f"{out_dir}/cleaned")
    sinks.write_table(spark.createDataFrame(list(classes.items()), "column string, kind string"), f"{out_dir}/column_classes")
    sinks.write_table(outliers.bounds_table(spark, bounds), f"{out_dir}/clamp_bounds")
    relations(spark, out_dir, directing, writing)


def relations(spark: SparkSession, out_dir: str, directing: str | None, writing: str | None) -> None:
    """Convert the crew relations that exist."""
    for path, role, name in ((directing, "director", "directing"), (writing, "writer", "writing")):
        if path is not None and tables.exists(spark, path):
            sinks.write_table(tables.read_relation(spark, path, role), f"{out_dir}/{name}")


def enrich_phase(spark: SparkSession, out_dir: str, payloads: DataFrame, vocabularies: DataFrame | None = None) -> None:
    """Join flattened metadata (tconst, payload) and fit, or apply, the vocabularies."""
    cleaned = spark.read.parquet(f"{out_dir}/cleaned")
    enriched, fitted = enrich.enrich_titles(cleaned, tables.flatten_payload(payloads), vocabularies)
    sinks.write_table(enriched, f"{out_dir}/enriched")
    if vocabularies is None:
        sinks.write_table(fitted, f"{out_dir}/vocabularies")


def graph_phase(spark: SparkSession, out_dir: str) -> None:
    """Join the crew features of the relations that exist."""
    directors = tables.optional_parquet(spark, f"{out_dir}/directing")
    writers = tables.optional_parquet(spark, f"{out_dir}/writing")
    features = graph.feature_matrix(spark.read.parquet(f"{out_dir}/enriched"), directors, writers)
    sinks.write_table(features, f"{out_dir}/features")


def prepare(
    spark: SparkSession,
    titles: str,
    payloads: DataFrame,
    out_dir: str,
    directing: str | None = None,
    writing: str | None = None,
) -> DataFrame:
    """All three phases; returns the feature table."""
    ingest(spark, titles, out_dir, directing, writing)
    enrich_phase(spark, out_dir, payloads)
    graph_phase(spark, out_dir)
    return spark.read.parquet(f"{out_dir}/features")
