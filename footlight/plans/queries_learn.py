"""Registered queries: model-based imputation, training, search, scoring.

Models are iterative and have no SQL twin, but what they must find can be planted: a label and a target that are exact functions
of one feature, which trees recover without error.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlight.operators import evaluate, impute, learn
from footlight.plans import experiments
from footlight.plans.dirt import dirty
from footlight.plans.registry import query, table
from footlight.session import materialise

# One modest parameter set for the queries that fit a given one; the searches go over the whole space.
PARAMS = {"n_estimators": 8, "learning_rate": 0.2, "max_depth": 3}
SETTINGS = impute.Settings(epochs=5)


def document_features(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.size(F.split("text", " ")).alias("n_words"),
        F.length(F.regexp_replace("text", r"[^0-9]", "")).alias("n_digits"),
        F.length(F.regexp_replace("text", r"[^.!?]", "")).alias("n_stops"),
        F.size(F.split("text", "\n")).alias("n_lines"),
    )


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return document_features(spark, sf).join(labels, "doc_id")


def _training(spark: SparkSession, sf: str):
    return learn.prepare(labelled_documents(spark, sf), key="doc_id")


@query()
def impute_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return impute.impute_column(dirty(spark, sf, "sparse_parts"), "p_retailprice", SETTINGS, text=[], ignored=["p_partkey"])


@query()
def impute_categorical(spark: SparkSession, sf: str) -> DataFrame:
    return impute.impute_column(dirty(spark, sf, "sparse_parts"), "p_brand", SETTINGS, text=["p_type"], ignored=["p_partkey"])


@query()
def impute_chain(spark: SparkSession, sf: str) -> DataFrame:
    parts = dirty(spark, sf, "sparse_parts")
    return impute.impute_chain(parts, ["p_size", "p_retailprice"], SETTINGS, text=[], ignored=["p_partkey"])


FEATURES = ["n_chars", "n_words", "n_digits", "n_stops", "n_lines", "lang", "source"]


# Codes of text columns go by falling frequency, then by value.
@query("""
with joined as (
  select d.*, l.quality,
    row_number() over (partition by l.quality order by md5(cast(d.doc_id as varchar) || '|42'), d.doc_id) as place,
    count(*) over (partition by l.quality) as size
  from documents d join labels l on d.doc_id = l.doc_id),
langs as (select lang, row_number() over (order by count(*) desc, lang) - 1 as code from joined group by lang),
sources as (select source, row_number() over (order by count(*) desc, source) - 1 as code from joined group by source)
select doc_id, quality::double as label, cast((place - 1) % 3 as integer) as fold,
  place <= ceil(cast(0.15 as double) * size) as is_holdout,
  n_chars::double as n_chars, len(string_split(text, ' '))::double as n_words,
  length(regexp_replace(text, '[^0-9]', '', 'g'))::double as n_digits,
  length(regexp_replace(text, '[^.!?]', '', 'g'))::double as n_stops,
  len(string_split(text, chr(10)))::double as n_lines, langs.code::double as lang, sources.code::double as source
from joined join langs on joined.lang = langs.lang join sources on joined.source = sources.source
""")
def ml_prepare(spark: SparkSession, sf: str) -> DataFrame:
    training, _ = _training(spark, sf)
    values = vector_to_array("features")
    return training.select("doc_id", "label", "fold", "is_holdout", *[values[i].alias(c) for i, c in enumerate(FEATURES)])


@query()
def train_eval(spark: SparkSession, sf: str) -> DataFrame:
    training, model = _training(spark, sf)
    return learn.evaluate_folds(learn.out_of_fold(training, PARAMS, "doc_id", learn.widest_category(model)))


@query()
def oof_union(spark: SparkSession, sf: str) -> DataFrame:
    training, model = _training(spark, sf)
    return learn.out_of_fold(training, PARAMS, "doc_id", learn.widest_category(model))


@query()
def cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    training, model = _training(spark, sf)
    return learn.cross_validate(training, [PARAMS], learn.widest_category(model))


# Trials of a finished search by application and folder: the queries of one session share them.
_SEARCHED: dict[tuple, DataFrame] = {}


@query()
def random_search(spark: SparkSession, sf: str) -> DataFrame:
    """The whole space, 25 trials of three folds."""
    at = (spark.sparkContext.applicationId, sf, "random")
    if at not in _SEARCHED:
        training, model = _training(spark, sf)
        trials = learn.sample_trials(learn.TRIALS, bounds=learn.BOUNDS)
        _SEARCHED[at] = materialise(learn.cross_validate(training, trials, learn.widest_category(model)), "random_search")
    return _SEARCHED[at]


@query()
def best_trial(spark: SparkSession, sf: str) -> DataFrame:
    return learn.best_trial(random_search(spark, sf))


@query()
def top_k_importance(spark: SparkSession, sf: str) -> DataFrame:
    training, model = _training(spark, sf)
    _, trees = learn.fit_final(training, model, PARAMS)
    return learn.feature_importance(trees, model, training)


@query()
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    training, model = _training(spark, sf)
    scoring, _ = learn.fit_final(training, model, PARAMS)
    return learn.score(scoring, document_features(spark, sf), "doc_id")


@query()
def oof_misclassified(spark: SparkSession, sf: str) -> DataFrame:
    training, model = _training(spark, sf)
    oof = learn.out_of_fold(training, PARAMS, "doc_id", learn.widest_category(model))
    return evaluate.misclassified(oof, table(spark, sf, "documents"), "doc_id", ["lang", "source", "n_chars"])


@query()
def experiment_grid(spark: SparkSession, sf: str) -> DataFrame:
    """All imputer settings, each followed by a full search."""
    documents = labelled_documents(spark, sf).withColumn(
        "n_words", F.when(F.col("doc_id") % 7 != 0, F.col("n_words"))
    )
    options = {"text": [], "ignored": ["doc_id", "label"]}
    return experiments.grid_search(
        documents, experiments.GRID, ["n_words"], key="doc_id", trials=learn.TRIALS, bounds=learn.BOUNDS, impute_options=options
    )


# 50 sizes need as many bins for the cut between 25 and 26 to be among those that trees try.
_BINS = 64


def planted_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return parts.withColumn("label", (F.col("p_size") > 25).cast("int"))


_FOLDS = """(select p_partkey, (p_size > 25)::integer as label,
  cast((row_number() over (partition by p_size > 25 order by md5(cast(p_partkey as varchar) || '|42'), p_partkey) - 1) % 3 as integer) as fold
  from part)"""


@query(f"select p_partkey, fold, label as true_label, label as predicted_label from {_FOLDS}")
def planted_out_of_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Out-of-fold predictions of a label that one feature decides: all right."""
    training, _ = learn.prepare(planted_parts(spark, sf), key="p_partkey")
    oof = learn.out_of_fold(training, PARAMS, "p_partkey", _BINS)
    return oof.select("p_partkey", "fold", "true_label", (F.col("predicted_prob") >= 0.5).cast("int").alias("predicted_label"))


@query(f"""
select 1.0::double as auc_pooled, 1.0::double as auc_mean_fold, count(*) filter (label = 1) as tp, 0::bigint as fp,
  count(*) filter (label = 0) as tn, 0::bigint as fn from {_FOLDS}
""")
def planted_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    training, _ = learn.prepare(planted_parts(spark, sf), key="p_partkey")
    found = learn.evaluate_folds(learn.out_of_fold(training, PARAMS, "p_partkey", _BINS))
    return found.select("auc_pooled", "auc_mean_fold", *[F.col(c).cast("long").alias(c) for c in ("tp", "fp", "tn", "fn")])


@query("select p_partkey, (p_size > 25)::integer as predicted_label from part")
def planted_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The model refitted on all rows scores all rows; the deciding feature alone has weight."""
    training, model = learn.prepare(planted_parts(spark, sf), key="p_partkey")
    scoring, _ = learn.fit_final(training, model, PARAMS, _BINS)
    return learn.score(scoring, planted_parts(spark, sf), "p_partkey").select("p_partkey", "predicted_label")


@query("select p_partkey, p_size % 20 as step, ((p_size % 20) // 5)::integer as grade from part")
def planted_fill(spark: SparkSession, sf: str) -> DataFrame:
    """A number that another column decides, missing in every third row: filled without error."""
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", (F.col("p_size") % 20).alias("step"))
    grade = F.floor(F.col("step") / 5).cast("int")
    gaps = parts.withColumn("grade", F.when(F.col("p_partkey") % 3 != 0, grade))
    return impute.impute_column(gaps, "grade", SETTINGS, text=[], ignored=["p_partkey"]).select("p_partkey", "step", "grade")
