"""Model selection: imputer settings x parameter search, winner artefacts, misclassification report."""

from __future__ import annotations

from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.operators import evaluate, impute, learn
from footlight.session import materialise
from footlight.sources import sinks

# --- Fixed values -----------------------------------------------------------
GRID = [impute.Settings(e, b, r) for e, b, r in product((5, 10), (64, 128), (1e-3, 5e-3))]
NO_IMPUTATION = impute.Settings(5, 64, 1e-3)
ID_COLUMNS = ["tconst", "primaryTitle", "originalTitle"]
KEY_FEATURES = [
    "runtimeMinutes",
    "numVotes",
    "tmdb_popularity",
    "tmdb_vote_average",
    "tmdb_primary_genre",
    "tmdb_original_language",
    "tmdb_origin_country",
    "director_avg_centrality",
    "writer_avg_centrality",
]
# ----------------------------------------------------------------------------


# Points of the grid that are searched at the same time.
POINTS = 8


def search(df: DataFrame, key: str, trials: int, bounds: dict | None, seed: int = 42, ledger: str | None = None, point: str = "") -> DataFrame:
    """(trial, <parameters>, trees, auc_mean_fold) of a seeded, model-based search over one feature table."""
    training, model = learn.prepare(df, key=key)
    return learn.model_search(training, trials, bounds, seed, learn.widest_category(model), ledger=ledger, point=point)


def grid_search(
    df: DataFrame,
    grid: list[impute.Settings] | None = None,
    targets: list[str] | None = None,
    key: str = "tconst",
    trials: int = learn.TRIALS,
    bounds: dict | None = None,
    impute_options: dict | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """(epochs, hidden, imputer_rate, trial, <parameters>, trees, auc_mean_fold) over imputer settings.

    The settings are a short list; every point is a sequence of distributed jobs over the whole table, ``POINTS`` of them at once.
    With ``ledger``, a folder, each finished fit is noted there: a search that was cut off goes on behind its last fit.
    """
    df = materialise(df, "features")

    def point(settings: impute.Settings) -> DataFrame:
        filled = impute.impute_chain(df, targets, settings, **(impute_options or {}))
        name = f"{settings.epochs}_{settings.hidden}_{settings.learning_rate}"
        return search(filled, key, trials, bounds, ledger=ledger, point=name).select(
            F.lit(settings.epochs).alias("epochs"),
            F.lit(settings.hidden).alias("hidden"),
            F.lit(settings.learning_rate).alias("imputer_rate"),
            "*",
        )

    with ThreadPool(POINTS) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(df.sparkSession)(point), grid or GRID, chunksize=1))


def run_experiments(
    features: DataFrame,
    out_dir: str,
    imputation: bool = False,
    key: str = "tconst",
    trials: int = learn.TRIALS,
    bounds: dict | None = None,
    grid: list[impute.Settings] | None = None,
    impute_options: dict | None = None,
) -> dict:
    """Search, refit the winner on all rows and write its artefacts under ``out_dir``; returns the winner's settings.

    Written: trials, winner (settings and parameters), model (scoring pipeline), imputers (with ``imputation``), category_map,
    oof_predictions, trial_report (metrics of the out-of-fold scores), importance, roc_curve, misclassified; in ledger every
    finished fit, so that a run that was cut off can be started again with the same ``out_dir``.
    """
    features = materialise(features, "features")
    if imputation:
        trials_table = grid_search(features, grid, key=key, trials=trials, bounds=bounds, impute_options=impute_options, ledger=f"{out_dir}/ledger")
    else:
        trials_table = search(features, key, trials, bounds, ledger=f"{out_dir}/ledger").select(
            F.lit(NO_IMPUTATION.epochs).alias("epochs"),
            F.lit(NO_IMPUTATION.hidden).alias("hidden"),
            F.lit(NO_IMPUTATION.learning_rate).alias("imputer_rate"),
            "*",
        )
    winner = learn.best_trial(trials_table).first().asDict()
    settings = impute.Settings(winner["epochs"], winner["hidden"], winner["imputer_rate"])
    params = {k: winner[k] for k in learn.PARAMETERS if winner[k] is not None}

    filled = features
    if imputation:
        chain, filled = impute.fit_chain(features, settings=settings, **(impute_options or {}))
        impute.save_chain(features.sparkSession, chain, f"{out_dir}/imputers")
    training, pipeline = learn.prepare(filled, key=key)
    widest = learn.widest_category(pipeline)
    oof = learn.out_of_fold(training, params, key, widest)
    model, trees = learn.fit_final(training, pipeline, params)

    sinks.write_table(trials_table, f"{out_dir}/trials")
    sinks.write_documents(learn.best_trial(trials_table).withColumn("imputation", F.lit(imputation)), f"{out_dir}/winner")
    model.write().overwrite().save(f"{out_dir}/model")
    sinks.write_table(learn.category_map(pipeline, filled), f"{out_dir}/category_map")
    sinks.write_table(oof, f"{out_dir}/oof_predictions")
    sinks.write_documents(learn.evaluate_folds(oof), f"{out_dir}/trial_report")
    sinks.write_table(evaluate.roc_curve(oof, "true_label", "predicted_prob"), f"{out_dir}/roc_curve")
    sinks.write_table(learn.feature_importance(trees, pipeline, filled), f"{out_dir}/importance")
    wanted = [*ID_COLUMNS, *KEY_FEATURES]
    sinks.write_report(evaluate.misclassified(oof, filled, key, wanted), f"{out_dir}/misclassified")
    return winner
