"""Filling missing values from the other columns with a model."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import (
    FeatureHasher,
    HashingTF,
    Imputer,
    IndexToString,
    Normalizer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footlight.functions.text import char_ngrams
from footlight.operators.ordering import quantiles
from footlight.session import materialise

# --- Fixed values -----------------------------------------------------------
TARGETS = ["runtimeMinutes", "numVotes", "startYear"]
TEXT = ["tmdb_production_company"]
IGNORED = ["tconst", "label", "synthetic_index", "syntheticIndex"]
MIN_TRAINING_ROWS = 50
MAX_CLASSES = 1000
HASH_FEATURES = 256
FILL_TEXT = "Unknown"
# Feature values in one partition of a training table.
VALUES = 4 << 20
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """``hidden`` is the width of a perceptron's first layer (the second has half); trees are as deep as its halvings allow.

    ``learning_rate`` is that of the trees, which predict numbers: the perceptron's solver finds its own steps.  Spark takes
    whole tables per step, so a batch size would have no effect and is no setting.
    """

    epochs: int = 5
    hidden: int = 64
    learning_rate: float = 0.001

    @property
    def depth(self) -> int:
        return max(1, self.hidden.bit_length() - 2)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, n, n_known, state): state is 'dense', 'hollow' or 'partial'; one aggregation."""
    columns = columns or df.columns
    cells = [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n"), F.count(c).alias("n_known")) for c in columns]
    state = (
        F.when(F.col("n_known") == F.col("n"), "dense").when(F.col("n_known") == 0, "hollow").otherwise("partial")
    )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")).withColumn("state", state)


def most_frequent(df: DataFrame, column: str):
    """Most frequent value, the smallest of equals; counted by group, one row is returned."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), column).limit(1).first()
    return None if top is None else top[column]


def fill_fallback(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls with the most frequent value (text) or the median (numbers)."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, F.coalesce(F.col(column), F.lit(most_frequent(df, column))))
    found = quantiles(df, [column], [0.5], interpolate=True).first()
    value = F.lit(found["value"] if found else None).cast("double")
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), value))


def too_many_classes(df: DataFrame, column: str, limit: int = MAX_CLASSES) -> bool:
    """Whether a column has more than ``limit`` distinct values; stops once they are found."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).count() > limit


def fill_high_cardinality(df: DataFrame, column: str, limit: int = MAX_CLASSES) -> DataFrame:
    """Text columns with more than ``limit`` distinct values get 'Unknown' for null; others are returned as they are."""
    if not too_many_classes(df, column, limit):
        return df
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(FILL_TEXT)))


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Centre on the mean and divide by the population deviation; nulls take the median first, a constant gives 0."""
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count(c).alias(c) for c in columns]).first()
    known = [c for c in columns if counts[c]]
    partial = [c for c in known if counts[c] < counts["_all"]]
    found = quantiles(df, partial, [0.5], interpolate=True).collect() if partial else []
    medians = {r["column"]: F.lit(r["value"]) for r in found}
    filled = {c: F.coalesce(F.col(c).cast("double"), medians.get(c, F.lit(None))) for c in known}
    if not filled:
        return df
    row = df.agg(*[F.struct(F.avg(e).alias("m"), F.stddev_pop(e).alias("s")).alias(c) for c, e in filled.items()]).first()
    return df.withColumns({c: (e - F.lit(row[c]["m"])) / F.lit(row[c]["s"] or 1.0) for c, e in filled.items()})


def _kinds(df: DataFrame, inputs: list[str], text: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Inputs that are texts, categories and numbers."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [c for c in inputs if c in text]
    categories = [c for c in inputs if c not in texts and isinstance(kinds[c], T.StringType)]
    return texts, categories, [c for c in inputs if isinstance(kinds[c], (T.NumericType, T.BooleanType))]


def prepared_inputs(df: DataFrame, inputs: list[str], text: list[str]) -> DataFrame:
    """Adds the columns that the feature stages read."""
    texts, categories, numbers = _kinds(df, inputs, text)
    return df.withColumns(
        {
            **{f"_g_{c}": char_ngrams(F.col(c)) for c in texts},
            **{f"_c_{c}": F.coalesce(F.col(c), F.lit("missing")) for c in categories},
            **{f"_n_{c}": F.col(c).cast("double") for c in numbers},
        }
    )


def feature_stages(df: DataFrame, inputs: list[str], text: list[str]) -> tuple[DataFrame, list]:
    """Columns prepared for, and stages of, the feature extractor: hashed n-grams, one-hot categories, scaled numbers."""
    texts, categories, numbers = _kinds(df, inputs, text)
    prepared = prepared_inputs(df, inputs, text)
    stages, parts = [], []
    for c in texts:
        stages += [
            HashingTF(inputCol=f"_g_{c}", outputCol=f"_h_{c}", numFeatures=HASH_FEATURES),
            Normalizer(inputCol=f"_h_{c}", outputCol=f"_v_{c}", p=2.0),
        ]
        parts.append(f"_v_{c}")
    # Columns of more values than HASH_FEATURES are hashed to that width, so neither labels nor vectors grow with the data.
    wide = [c for c in categories if too_many_classes(prepared, f"_c_{c}", HASH_FEATURES)]
    stages += [FeatureHasher(inputCols=[f"_c_{c}"], outputCol=f"_o_{c}", numFeatures=HASH_FEATURES) for c in wide]
    narrow = [c for c in categories if c not in wide]
    if narrow:
        stages += [
            StringIndexer(inputCols=[f"_c_{c}" for c in narrow], outputCols=[f"_i_{c}" for c in narrow], handleInvalid="keep"),
            OneHotEncoder(inputCols=[f"_i_{c}" for c in narrow], outputCols=[f"_o_{c}" for c in narrow], handleInvalid="keep"),
        ]
    parts += [f"_o_{c}" for c in categories]
    if numbers:
        stages += [
            Imputer(strategy="median", inputCols=[f"_n_{c}" for c in numbers], outputCols=[f"_m_{c}" for c in numbers]),
            VectorAssembler(inputCols=[f"_m_{c}" for c in numbers], outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True),
        ]
        parts.append("_scaled")
    stages.append(VectorAssembler(inputCols=parts, outputCol="_features"))
    return prepared, stages


def _spread(rows: DataFrame, n: int, values: int) -> DataFrame:
    """``n`` rows dealt to partitions of about ``VALUES`` feature values, if one partition cannot hold them.

    Learners keep each partition's features and read them in every pass; a scan of few bytes has few partitions, whatever its rows
    grow to.
    """
    parts = -(-n * max(values, 1) // VALUES)
    return rows if parts < 2 else rows.repartition(parts)


def imputation_branch(
    df: DataFrame, target: str, min_training_rows: int = MIN_TRAINING_ROWS, max_classes: int = MAX_CLASSES
) -> str:
    """What ``impute_column`` does with a column: 'dense', 'hollow', 'fallback', 'unknown' or 'model'."""
    state, known = null_profile(df, [target]).select("state", "n_known").first()
    if state != "partial":
        return state
    if known < min_training_rows:
        return "fallback"
    is_text = isinstance(df.schema[target].dataType, T.StringType)
    return "unknown" if is_text and too_many_classes(df, target, max_classes) else "model"


@dataclass
class ColumnImputer:
    """What fills one column: a model over ``inputs`` or one value, fitted once and applied to any table with these columns."""

    target: str
    kind: str
    branch: str
    inputs: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    value: str | float | None = None
    model: PipelineModel | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        """Known values and all other columns stay as they are."""
        target = F.col(self.target)
        if self.model is None:
            if self.value is None:
                return df
            return df.withColumn(self.target, F.coalesce(target, F.lit(self.value).cast(df.schema[self.target].dataType)))
        missing = prepared_inputs(df.where(target.isNull()), self.inputs, self.text)
        value = F.col("_value")
        if isinstance(df.schema[self.target].dataType, T.IntegralType):
            value = F.round(value)
        filled = self.model.transform(missing).withColumn(self.target, value.cast(df.schema[self.target].dataType))
        return df.where(target.isNotNull()).unionByName(filled.select(*df.columns))


def _typical(df: DataFrame, column: str):
    """The most frequent value of a text column, the median of any other."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return most_frequent(df, column)
    found = quantiles(df, [column], [0.5], interpolate=True).first()
    return found["value"] if found else None


def fit_imputer(
    df: DataFrame,
    target: str,
    settings: Settings = Settings(),
    text: list[str] | None = None,
    ignored: list[str] | None = None,
    min_training_rows: int = MIN_TRAINING_ROWS,
    max_classes: int = MAX_CLASSES,
    later: bool = False,
) -> ColumnImputer:
    """Learn to predict the nulls of ``target`` from the other columns.

    Numbers use boosted regression trees (Spark has no perceptron regressor), text classes a perceptron.  A fully
    known or fully null target is left alone; fewer than ``min_training_rows`` known rows fall back to mode or median,
    more than ``max_classes`` classes to 'Unknown' (``imputation_branch`` tells which of these applies).  ``later``: the imputer will
    meet other tables, so a fully known target gets its typical value.
    """
    text = TEXT if text is None else text
    ignored = IGNORED if ignored is None else ignored
    branch = imputation_branch(df, target, min_training_rows, max_classes)
    kind = df.schema[target].dataType
    out = ColumnImputer(target, kind.simpleString(), branch, text=text)
    if branch == "fallback" or branch == "dense" and later:
        out.value = _typical(df, target)
    if branch == "unknown":
        out.value = FILL_TEXT
    if branch != "model":
        return out

    inputs = [c for c in df.columns if c != target and c not in ignored]
    counts = df.agg(F.count(target).alias("_known"), *[F.count(F.when(F.col(target).isNotNull(), F.col(c))).alias(c) for c in inputs]).first()
    out.inputs = [c for c in inputs if counts[c]]
    texts, categories, numbers = _kinds(df, out.inputs, text)
    _, stages = feature_stages(df, out.inputs, text)
    known = _spread(df.where(F.col(target).isNotNull()), counts["_known"], HASH_FEATURES * len(texts + categories) + len(numbers))
    training = prepared_inputs(known, out.inputs, text)
    if isinstance(kind, T.StringType):
        features = Pipeline(stages=stages + [StringIndexer(inputCol=target, outputCol="_class")]).fit(training)
        classes = features.stages[-1].labels  # max_classes at most
        encoded = features.transform(training)
        width = len(encoded.select("_features").first()[0])
        network = MultilayerPerceptronClassifier(
            layers=[width, settings.hidden, max(settings.hidden // 2, 1), len(classes)],
            maxIter=settings.epochs * 10,
            featuresCol="_features",
            labelCol="_class",
            predictionCol="_prediction",
            seed=42,
        ).fit(encoded)
        # The target indexer, last among the stages, has nothing to index in the rows to predict.
        named = IndexToString(inputCol="_prediction", outputCol="_value", labels=classes)
        out.model = PipelineModel(stages=[*features.stages[:-1], network, named])
        return out
    trees = GBTRegressor(
        featuresCol="_features",
        labelCol="_target",
        predictionCol="_value",
        maxIter=settings.epochs,
        stepSize=settings.learning_rate,
        maxDepth=settings.depth,
        seed=42,
    )
    out.model = Pipeline(stages=[*stages, trees]).fit(training.withColumn("_target", F.col(target).cast("double")))
    return out


def impute_column(df: DataFrame, target: str, settings: Settings = Settings(), **options) -> DataFrame:
    """Fill ``target`` by an imputer fitted on the same table (see ``fit_imputer``)."""
    return fit_imputer(df, target, settings, **options).apply(df)


def fit_chain(df: DataFrame, targets: list[str] | None = None, settings: Settings = Settings(), **options) -> tuple[list[ColumnImputer], DataFrame]:
    """Imputers of several targets in turn, and the filled table; later ones see earlier fills.  Each step is written before the next."""
    chain, out = [], df
    for target in [t for t in (targets or TARGETS) if t in df.columns]:
        chain.append(fit_imputer(out, target, settings, **options))
        out = materialise(chain[-1].apply(out), "imputed")
    return chain, out


def apply_chain(df: DataFrame, chain: list[ColumnImputer]) -> DataFrame:
    """Fill a table as the table that the chain was fitted on: a row's fill does not depend on the other rows of its batch."""
    for imputer in chain:
        if imputer.target in df.columns:
            df = materialise(imputer.apply(df), "imputed")
    return df


def impute_chain(df: DataFrame, targets: list[str] | None = None, settings: Settings = Settings(), **options) -> DataFrame:
    """Impute several targets in turn by imputers fitted on the same table."""
    return fit_chain(df, targets, settings, **options)[1]


def save_chain(spark: SparkSession, chain: list[ColumnImputer], path: str) -> None:
    """One row per imputer, in order, and a folder per model."""
    rows = [(i, json.dumps({k: v for k, v in vars(f).items() if k != "model"}), f.model is not None) for i, f in enumerate(chain)]
    spark.createDataFrame(rows, "place int, state string, has_model boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/chain")
    for i, f in enumerate(chain):
        if f.model is not None:
            f.model.write().overwrite().save(f"{path}/model-{i}")


def load_chain(spark: SparkSession, path: str) -> list[ColumnImputer]:
    chain = []
    for r in spark.read.parquet(f"{path}/chain").orderBy("place").collect():
        chain.append(ColumnImputer(**json.loads(r["state"]), model=PipelineModel.load(f"{path}/model-{r['place']}") if r["has_model"] else None))
    return chain
