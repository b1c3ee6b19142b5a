"""Scoring of new title files with the artefacts of training."""

from __future__ import annotations

from datetime import datetime, timezone
from pathlib import PurePosixPath

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from footlight.operators import evaluate, impute, learn, outliers
from footlight.plans import prepare
from footlight.sources import sinks, tables


def score_titles(
    spark: SparkSession,
    titles: str,
    payloads: DataFrame,
    training_dir: str,
    model_dir: str,
    out_dir: str,
    directing: str | None = None,
    writing: str | None = None,
    imputation: bool = False,
) -> DataFrame:
    """(tconst, predicted_prob, predicted_label) for the rows of ``titles``.

    Column types, clamp limits, vocabularies, category codes and (``imputation``) imputers are those fitted in training.
    """
    classes = {r["column"]: r["kind"] for r in spark.read.parquet(f"{training_dir}/column_classes").collect()}
    bounds = outliers.load_bounds(spark.read.parquet(f"{training_dir}/clamp_bounds"))
    cleaned = outliers.clamp(tables.read_titles(spark, titles, "titles", classes), bounds)
    sinks.write_table(cleaned, f"{out_dir}/cleaned")
    prepare.relations(spark, out_dir, directing, writing)
    prepare.enrich_phase(spark, out_dir, payloads, spark.read.parquet(f"{training_dir}/vocabularies"))
    prepare.graph_phase(spark, out_dir)
    features = spark.read.parquet(f"{out_dir}/features")
    if imputation:
        features = impute.apply_chain(features, impute.load_chain(spark, f"{model_dir}/imputers"))
    return learn.score(PipelineModel.load(f"{model_dir}/model"), features, "tconst")


def write_predictions(spark: SparkSession, titles: str, predictions: DataFrame, out_dir: str) -> str:
    """'True' / 'False' lines in the order of the input file, under a time-stamped name; returns the folder."""
    keys = tables.read_raw_csv(spark, titles, with_order=True).select("tconst", *tables.ORDER)
    ordered = evaluate.ordered_predictions(keys, predictions, "tconst", tables.ORDER)
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    path = f"{out_dir}/{PurePosixPath(titles).stem}_predictions_{stamp}"
    sinks.write_lines(ordered, path, order=tables.ORDER)
    return path
