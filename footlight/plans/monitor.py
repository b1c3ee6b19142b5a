"""Drift check of a serving feature table against the training one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footlight.operators import drift
from footlight.session import materialise
from footlight.sources import sinks


def monitor(baseline: DataFrame, serving: DataFrame, out_dir: str, **options) -> bool:
    """Write the drift metrics and the passport document; returns whether retraining is recommended."""
    metrics = materialise(drift.drift_metrics(baseline, serving, **options), "drift_metrics")
    sinks.write_table(metrics, f"{out_dir}/drift_metrics")
    sinks.write_lines(drift.passport(metrics, serving), f"{out_dir}/data_passport", "passport")
    return not metrics.where("drifted").isEmpty()
