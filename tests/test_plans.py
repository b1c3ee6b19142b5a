import json
import os

import pytest
from pyspark.sql import functions as F

from footlight.plans import analysis, monitor


@pytest.fixture(scope="module")
def features(spark):
    return spark.range(120).select(
        F.concat(F.lit("tt"), "id").alias("tconst"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 4 < 3, F.element_at(F.array(F.lit("drama"), F.lit("war")), (F.col("id") % 2 + 1).cast("int"))).alias(analysis.GENRE),
        (F.col("id") % 3 == 0).alias("tmdb_success"),
        F.col("id").cast("double").alias("numVotes"),
        (F.col("id") * F.col("id")).cast("double").alias("squared"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 7).alias("gaps"),
        F.lit(2000).alias("startYear"),
    )


def test_collinearity(spark, features, tmp_path):
    pairs = analysis.collinearity(features, str(tmp_path)).collect()
    assert [(r["x"], r["y"]) for r in pairs][0] == ("numVotes", "squared") and pairs[0]["strength"] == pytest.approx(1.0)
    matrix = spark.read.parquet(f"{tmp_path}/spearman_matrix")
    assert matrix.count() == 36 and "startYear" not in {r["x"] for r in matrix.collect()}
    codes = {r[0] for r in analysis.encode(features).select(analysis.GENRE).distinct().collect()}
    assert codes == {-1, 0, 1}


def test_association(spark, features, tmp_path):
    test = analysis.association(features, str(tmp_path)).first()
    assert test["dof"] == 1 and test["p_value"] < 1e-6 and test["cramers_v"] > 0.9
    assert spark.read.parquet(f"{tmp_path}/contingency").count() == 2
    assert spark.read.parquet(f"{tmp_path}/overall_rate").first()["n"] == 120


def test_monitor(features, tmp_path):
    moved = features.withColumn("numVotes", F.col("numVotes") + 500)
    assert monitor.monitor(features, moved, str(tmp_path)) is True
    parts = [n for n in os.listdir(f"{tmp_path}/data_passport") if n.startswith("part-")]
    text = "".join(open(f"{tmp_path}/data_passport/{n}").read() for n in parts)
    assert json.loads(text)["retrain_recommended"] is True
    assert monitor.monitor(features, features, str(tmp_path)) is False
