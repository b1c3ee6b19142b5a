"""Binary classification metrics from a score and a 0/1 label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.functions.cells import truth_text
from footlight.operators.ordering import running_values

THRESHOLD = 0.5  # fixed value


def predicted(score: str, threshold: float = THRESHOLD):
    return (F.col(score) >= F.lit(threshold)).cast("int")


def confusion_counts(df: DataFrame, label: str, score: str, threshold: float = THRESHOLD) -> DataFrame:
    """(tp, fp, tn, fn), one row."""
    hit, real = predicted(score, threshold) == 1, F.col(label) == 1
    return df.agg(
        F.count_if(hit & real).alias("tp"),
        F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & ~real).alias("tn"),
        F.count_if(~hit & real).alias("fn"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, sensitivity and specificity; 0 where the denominator is 0."""

    def share(part, whole):
        return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))

    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        "tp",
        "fp",
        "tn",
        "fn",
        share(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("sensitivity"),
        share(tn, tn + fp).alias("specificity"),
    )


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = THRESHOLD) -> DataFrame:
    return rates(confusion_counts(df, label, score, threshold))


def _score_totals(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    measures = {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)}
    return running_values(df, score, measures, by)


def roc_auc(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(<by>, auc): chance that a positive outscores a negative, ties counting half; null when a class is missing."""
    totals = _score_totals(df, label, score, by)
    below = F.col("cum_neg") - F.col("neg") / F.lit(2.0).cast("double")
    pairs = F.max("all_pos").cast("double") * F.max("all_neg")
    return totals.groupBy(*by).agg(F.when(pairs > 0, F.sum(F.col("pos") * below) / pairs).alias("auc"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score plus the origin at infinity."""
    totals = _score_totals(df, label, score)

    def share(part: str):
        above = F.col(f"all_{part}") - F.col(f"cum_{part}") + F.col(part)
        return F.when(F.col(f"all_{part}") > 0, above.cast("double") / F.col(f"all_{part}"))

    points = totals.select(F.col(score).cast("double").alias("threshold"), share("neg").alias("fpr"), share("pos").alias("tpr"))
    zero = F.lit(0.0)
    origin = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), zero.alias("fpr"), zero.alias("tpr"))
    return points.unionByName(origin)


def misclassified(
    predictions: DataFrame,
    features: DataFrame,
    key: str,
    columns: list[str],
    label: str = "true_label",
    score: str = "predicted_prob",
) -> DataFrame:
    """Wrong predictions with their identifiers and the wanted feature columns that exist."""
    wrong = predictions.withColumn("predicted_label", predicted(score)).where(F.col("predicted_label") != F.col(label))
    kept = [c for c in columns if c in features.columns and c != key]
    return wrong.join(features.select(key, *kept), key, "left").select(key, label, score, "predicted_label", *kept)


def misclassification_rate(df: DataFrame, label: str, score: str) -> DataFrame:
    """(n_total, n_wrong, wrong_rate)."""
    wrong = predicted(score) != F.col(label)
    return df.agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(wrong).alias("n_wrong"), F.avg(wrong.cast("double")).alias("wrong_rate")
    )


def ordered_predictions(keys: DataFrame, predictions: DataFrame, key: str, order: list[str], label: str = "predicted_label") -> DataFrame:
    """'True' / 'False' for every input key; a key without prediction is 'False'.  ``order`` columns keep the input order."""
    flag = F.coalesce(F.col(label), F.lit(0)) == 1
    merged = keys.join(predictions.select(key, label), key, "left")
    return merged.select(*order, key, truth_text(flag).alias("prediction"))


def align_features(df: DataFrame, columns: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """The fitted feature columns in fitted order; an absent one is filled with 0."""
    return df.select(*extra, *[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in columns])
