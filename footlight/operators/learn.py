"""Boosted-tree training: feature assembly, search, cross-validation, out-of-fold predictions, scoring."""

from __future__ import annotations

import json
import random
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footlight.operators import boosting, fits
from footlight.operators.boosting import Boosted
from footlight.operators.codes import CategoryCodes, fit_codes
from footlight.operators.evaluate import classification_metrics, roc_auc
from footlight.operators.folds import stratified_folds, stratified_holdout
from footlight.operators.search import STARTUP, draw, suggest
from footlight.session import materialise

# --- Fixed values -----------------------------------------------------------
DROPPED = ["tconst", "syntheticIndex", "synthetic_index", "primaryTitle", "originalTitle", "C1", "tmdb_success"]
BOUNDS = {
    "max_depth": (3, 10),
    "learning_rate": (0.01, 0.3),
    "n_estimators": (50, 600),
    "reg_alpha": (0.0, 40.0),
    "reg_lambda": (0.0, 40.0),
}
TRIALS = 25
FOLDS = 3
HOLDOUT = 0.15
TOP_FEATURES = 15
BINS = 32
FILL_TEXT = "Unknown"
# ----------------------------------------------------------------------------

# Parameters by their own names, and as ``boosting.fit`` calls them; those without bounds are not searched unless asked for.
PARAMETERS = {
    "n_estimators": "rounds",
    "learning_rate": "rate",
    "max_depth": "depth",
    "reg_alpha": "alpha",
    "reg_lambda": "lam",
    "min_info_gain": "min_gain",
    "min_instances": "min_rows",
    "subsample": "subsample",
}
TRIAL_SCHEMA = (
    "trial int, n_estimators int, learning_rate double, max_depth int, reg_alpha double, reg_lambda double, "
    "min_info_gain double, min_instances int, subsample double, trees double, auc_mean_fold double"
)
LEDGER = "point string, trial int, fold int, params string, trees int, auc double"
# Trials suggested at once: their fits run side by side.
BATCH = 5


def feature_columns(df: DataFrame, label: str = "label", dropped: list[str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, text) feature columns: everything but the label and the drop list."""
    dropped = DROPPED if dropped is None else dropped
    wanted = [f for f in df.schema.fields if f.name not in dropped and f.name != label]
    texts = [f.name for f in wanted if isinstance(f.dataType, T.StringType)]
    return [f.name for f in wanted if f.name not in texts], texts


def feature_pipeline(df: DataFrame, numeric: list[str], texts: list[str]) -> PipelineModel:
    """Code text columns (unseen values get their own code), fill numbers with their median, assemble 'features'.

    Numeric columns without any value are left out: they have no median.
    """
    counts = df.agg(*[F.count(c).alias(c) for c in numeric]).first() if numeric else {}
    numeric = [c for c in numeric if counts[c]]
    ready = typed(df, numeric, texts)
    stages = [fit_codes(ready, texts)] if texts else []
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_num" for c in numeric]).fit(ready))
    inputs = [f"{c}_num" for c in numeric] + [f"{c}_idx" for c in texts]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return PipelineModel(stages=stages)


def typed(df: DataFrame, numeric: list[str], texts: list[str]) -> DataFrame:
    """Numbers as double, null text as 'Unknown': the form the feature pipeline reads."""
    return df.withColumns(
        {
            **{c: F.col(c).cast("double") for c in numeric},
            **{c: F.coalesce(F.col(c), F.lit(FILL_TEXT)) for c in texts},
        }
    )


def _codes(model: PipelineModel) -> CategoryCodes | None:
    return next((s for s in model.stages if isinstance(s, CategoryCodes)), None)


def category_map(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(column, value, code) of the fitted codes."""
    codes = _codes(model)
    if codes is None:
        return df.sparkSession.createDataFrame([], "column string, value string, code int")
    return codes.table.select("column", "value", "code")


def widest_category(model: PipelineModel) -> int:
    codes = _codes(model)
    return codes.widest if codes else 0


def prepare(df: DataFrame, label: str = "label", key: str = "tconst", dropped: list[str] | None = None) -> tuple[DataFrame, PipelineModel]:
    """Training table (key, label, features, fold, is_holdout), written once, and the fitted feature pipeline.

    The labelled rows are written before the pipeline is fitted on them, and the features again after it:
    neither fitting nor training repeats the work that led to its input.
    """
    dropped = [*(DROPPED if dropped is None else dropped), key]
    numeric, texts = feature_columns(df, label, dropped)
    labelled = materialise(df.where(F.col(label).isNotNull()).select(key, label, *numeric, *texts), "labelled")
    model = feature_pipeline(labelled, numeric, texts)
    assembled = model.transform(typed(labelled, numeric, texts))
    ready = assembled.select(key, F.col(label).cast("double").alias("label"), "features")
    split = stratified_holdout(stratified_folds(ready, "label", key, FOLDS), "label", key, HOLDOUT)
    return materialise(split, "training"), model


def fit_trees(training: DataFrame, params: dict, widest: int = 0, early_stopping: bool = True) -> Boosted:
    """Boosted trees for one parameter set; with ``early_stopping`` the rows of ``is_holdout`` decide their number."""
    return boosting.fit(training, holdout="is_holdout" if early_stopping else None, bins=max(BINS, widest), **_arguments(params))


def _arguments(params: dict) -> dict:
    """Parameters by the names of ``boosting.fit``."""
    return {"rounds": 20, "rate": 0.1, "depth": 5, **{PARAMETERS[k]: v for k, v in params.items() if v is not None}}


def sample_trials(n: int = TRIALS, seed: int = 42, bounds: dict | None = None) -> list[dict]:
    """Seeded random search points; the learning rate is drawn log-uniformly."""
    rng = random.Random(seed)
    return [{k: draw(k, *b, rng) for k, b in (bounds or BOUNDS).items()} for _ in range(n)]


def read_ledger(training: DataFrame, path: str) -> dict[tuple, tuple[int, float]]:
    """{(point, trial, fold, params): (trees, auc)} of the fits that an earlier run has finished."""
    try:
        rows = training.sparkSession.read.schema(LEDGER).parquet(f"{path}/*").collect()
    except AnalysisException:  # nothing written yet
        return {}
    return {(r["point"], r["trial"], r["fold"], r["params"]): (r["trees"], r["auc"]) for r in rows}


def cross_validate(
    training: DataFrame,
    trials: list[dict],
    widest: int = 0,
    parallelism: int | None = None,
    first: int = 0,
    ledger: str | None = None,
    point: str = "",
) -> DataFrame:
    """(trial, <parameters>, trees, auc_mean_fold) per parameter set, folds taken from the table's fold column.

    Without ``ledger`` the fits of a table of bounded size are dealt to tasks (see ``fits``).  Else they run side by side, as many as the
    session has cores unless told.  With ``ledger``, a folder, every finished fit is written there at once and is not repeated by a later
    run with the same ``point``; trials count from ``first``.
    """
    rows = _tried(training, trials, widest, parallelism, first, ledger, point, not ledger and fits.bounded(training))
    return training.sparkSession.createDataFrame(rows, TRIAL_SCHEMA)


def _tried(
    training: DataFrame, trials: list[dict], widest: int, parallelism: int | None, first: int, ledger: str | None, point: str, dealt: bool
) -> list[tuple]:
    """The rows of ``cross_validate``; ``dealt``: the table is of bounded size and there is no ledger."""
    spark = training.sparkSession
    done = read_ledger(training, ledger) if ledger else {}

    def fitted(task: tuple[int, int]) -> tuple[int, float | None]:
        i, fold = task
        text = json.dumps(trials[i], sort_keys=True)
        known = done.get((point, first + i, fold, text))
        if known:
            return known
        model = fit_trees(training.where(F.col("fold") != fold), trials[i], widest)
        scored = model.transform(training.where(F.col("fold") == fold))
        auc = roc_auc(scored, "label", "predicted_prob").first()["auc"]
        if ledger:
            row = spark.createDataFrame([(point, first + i, fold, text, len(model.trees), auc)], LEDGER)
            row.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/fit-{point}-{first + i}-{fold}")
        return len(model.trees), auc

    tasks = [(i, fold) for i in range(len(trials)) for fold in range(FOLDS)]
    each = [(fold, _arguments(trials[i])) for i, fold in tasks]
    workers = parallelism or max(2, min(spark.sparkContext.defaultParallelism, len(tasks)))
    if dealt and all(own.get("subsample", 1) == 1 for _, own in each):
        # The longest first, so that no task is alone at the end.
        order = sorted(range(len(tasks)), key=lambda n: -each[n][1]["rounds"] * each[n][1]["depth"])
        areas = fits.area_each(training, [each[n] for n in order], max(BINS, widest)).collect()
        found = {tasks[order[r["fit"]]]: (r["trees"], r["auc"]) for r in areas}
    else:
        with ThreadPool(workers) as pool:
            found = dict(zip(tasks, pool.map(inheritable_thread_target(spark)(fitted), tasks, chunksize=1)))
    rows = []
    for i, t in enumerate(trials):
        trees, aucs = zip(*[found[i, fold] for fold in range(FOLDS)])
        known = [a for a in aucs if a is not None]  # a fold without one of the classes has none
        mean = sum(known) / len(known) if known else None
        rows.append((first + i, *[t.get(name) for name in PARAMETERS], sum(trees) / FOLDS, mean))
    return rows


def model_search(
    training: DataFrame,
    n: int = TRIALS,
    bounds: dict | None = None,
    seed: int = 42,
    widest: int = 0,
    batch: int = BATCH,
    ledger: str | None = None,
    point: str = "",
) -> DataFrame:
    """The table of ``cross_validate`` for ``n`` trials, each batch suggested by what the earlier ones have found.

    The first ``STARTUP`` trials do not look at any other, so they are one batch, whatever ``batch`` is.
    """
    bounds = bounds or BOUNDS
    dealt = not ledger and fits.bounded(training)
    rows: list[tuple] = []
    while len(rows) < n:
        named = [dict(zip(["trial", *PARAMETERS, "trees", "auc_mean_fold"], r)) for r in rows]
        finished = [({k: r[k] for k in bounds}, r["auc_mean_fold"]) for r in named]
        trials = suggest(finished, bounds, min(max(batch, STARTUP - len(rows)), n - len(rows)), seed)
        rows += _tried(training, trials, widest, None, len(rows), ledger, point, dealt)
    return training.sparkSession.createDataFrame(rows, TRIAL_SCHEMA)


def best_trial(trials: DataFrame, metric: str = "auc_mean_fold") -> DataFrame:
    """The row with the largest metric, the lowest trial number among equals."""
    return trials.orderBy(F.desc_nulls_last(metric), "trial").limit(1)


def out_of_fold(training: DataFrame, params: dict, key: str = "tconst", widest: int = 0) -> DataFrame:
    """(key, fold, true_label, predicted_prob): every row scored by the model that did not see its fold; written once."""

    def scored(k: int) -> DataFrame:
        model = fit_trees(training.where(F.col("fold") != k), params, widest)
        columns = [key, "fold", F.col("label").cast("int").alias("true_label"), "predicted_prob"]
        return model.transform(training.where(F.col("fold") == k)).select(*columns)

    with ThreadPool(FOLDS) as pool:  # one driver thread per fold; the fits share the cluster
        parts = pool.map(inheritable_thread_target(training.sparkSession)(scored), range(FOLDS))
    return materialise(reduce(DataFrame.unionByName, parts), "out_of_fold")


def evaluate_folds(oof: DataFrame) -> DataFrame:
    """One row: AUC of the pooled scores, mean of the folds' AUCs, confusion counts and rates."""
    pooled = roc_auc(oof, "true_label", "predicted_prob").select(F.col("auc").alias("auc_pooled"))
    per_fold = roc_auc(oof, "true_label", "predicted_prob", by=("fold",)).agg(F.avg("auc").alias("auc_mean_fold"))
    metrics = classification_metrics(oof, "true_label", "predicted_prob")
    return metrics.withColumns({"auc_pooled": pooled.scalar(), "auc_mean_fold": per_fold.scalar()})


def feature_importance(model: Boosted, pipeline: PipelineModel, df: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    """(feature, importance), largest first."""
    names = pipeline.stages[-1].getInputCols()
    values = model.importances or [0.0] * len(names)
    rows = [(n.removesuffix("_num").removesuffix("_idx"), float(v)) for n, v in zip(names, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def fit_final(training: DataFrame, pipeline: PipelineModel, params: dict, widest: int | None = None) -> tuple[PipelineModel, Boosted]:
    """Refit on every row; returns the whole scoring pipeline and its trees."""
    widest = widest_category(pipeline) if widest is None else widest
    trees = fit_trees(training, params, widest, early_stopping=False)
    return PipelineModel(stages=[*pipeline.stages, *trees.stages()]), trees


def score(model: PipelineModel, df: DataFrame, key: str, threshold: float = 0.5) -> DataFrame:
    """(key, predicted_prob, predicted_label).  Absent feature columns count as 0."""
    codes = _codes(model)
    texts = codes.columns if codes else []
    numeric = [c for s in model.stages if hasattr(s, "surrogateDF") for c in s.getInputCols()]
    aligned = df.withColumns(
        {
            **{c: F.lit(0.0) for c in numeric if c not in df.columns},
            **{c: F.lit("0") for c in texts if c not in df.columns},
        }
    )
    scored = model.transform(typed(aligned, numeric, texts).select(key, *numeric, *texts))
    return scored.select(key, "predicted_prob", (F.col("predicted_prob") >= threshold).cast("int").alias("predicted_label"))
