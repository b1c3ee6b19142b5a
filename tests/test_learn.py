import json
import math
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from footlight.operators import categorical, impute, learn
from footlight.plans import experiments, inference, prepare

PARAMS = {"n_estimators": 4, "learning_rate": 0.2, "max_depth": 3}
BOUNDS = {**learn.BOUNDS, "n_estimators": (3, 4), "max_depth": (3, 3)}


@pytest.fixture(scope="module")
def examples(spark):
    noisy = F.when(F.rand(7) < 0.1, 1 - (F.col("id") % 2)).otherwise(F.col("id") % 2)
    return spark.range(300).select(
        F.concat(F.lit("tt"), "id").alias("tconst"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 9 != 0, noisy * 3 + F.rand(1)).alias("signal"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 5).cast("string")).alias("kind"),
        F.lit(None).cast("double").alias("hollow"),
    )


def test_training_table(spark, examples):
    training, model = learn.prepare(examples)
    rows = training.collect()
    assert len(rows) == 300 and {r["fold"] for r in rows} == {0, 1, 2}
    assert model.stages[-1].getInputCols() == ["signal_num", "kind_idx"]  # the hollow column has no median
    assert not any(math.isnan(v) for r in rows for v in r["features"].toArray())
    codes = learn.category_map(model, examples).collect()
    assert {r["value"] for r in codes} == {"0", "1", "2", "3", "4", "Unknown"} and sorted(r["code"] for r in codes) == list(range(6))


def test_out_of_fold_predictions_learn_the_signal(spark, examples):
    training, model = learn.prepare(examples)
    oof = learn.out_of_fold(training, PARAMS, widest=learn.widest_category(model))
    assert oof.count() == 300 and oof.select("tconst").distinct().count() == 300
    got = learn.evaluate_folds(oof).first()
    # One label in ten is flipped and one signal in nine is missing, so even the true rule stays near 0.84.
    assert got["auc_pooled"] > 0.8 and got["auc_mean_fold"] > 0.8
    assert got["tp"] + got["fp"] + got["tn"] + got["fn"] == 300


def test_search_picks_the_best(spark, examples):
    training, _ = learn.prepare(examples)
    trials = learn.cross_validate(training, learn.sample_trials(2, bounds=BOUNDS))
    rows = trials.collect()
    assert [r["trial"] for r in rows] == [0, 1]
    best = learn.best_trial(trials).first()
    assert best["auc_mean_fold"] == max(r["auc_mean_fold"] for r in rows)


def test_trials_are_seeded_and_in_bounds():
    trials = learn.sample_trials()
    assert len(trials) == 25 and trials == learn.sample_trials() and trials != learn.sample_trials(seed=1)
    assert all(low <= t[k] <= high for t in trials for k, (low, high) in learn.BOUNDS.items())


def test_scoring_tolerates_new_values_and_absent_columns(spark, examples, tmp_path):
    training, pipeline = learn.prepare(examples)
    model, trees = learn.fit_final(training, pipeline, PARAMS)
    model.write().overwrite().save(f"{tmp_path}/model")
    new = spark.createDataFrame([("x", 3.5, "never seen"), ("y", None, None)], "tconst string, signal double, kind string")
    got = learn.score(PipelineModel.load(f"{tmp_path}/model"), new, "tconst").collect()
    assert {r["tconst"]: r["predicted_label"] for r in got}["x"] == 1
    assert learn.score(model, new.drop("signal"), "tconst").count() == 2
    top = learn.feature_importance(trees, pipeline, training).collect()
    assert top[0]["feature"] == "signal"


# ---------------------------------------------------------------- imputation


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.range(240).select(
        "id",
        F.when(F.col("id") % 4 != 0, (F.col("id") % 3 * 10).cast("int")).alias("number"),
        F.when(F.col("id") % 5 != 0, F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int"))).alias("letter"),
        (F.col("id") % 3).cast("double").alias("clue"),
        F.lit(None).cast("double").alias("hollow"),
    )


def filled(before, after, column):
    old = {r["id"]: r[column] for r in before.collect()}
    new = {r["id"]: r[column] for r in after.collect()}
    assert set(old) == set(new) and all(new[i] == v for i, v in old.items() if v is not None)
    assert all(v is not None for v in new.values())
    return {i: new[i] for i, v in old.items() if v is None}


def test_numbers_are_predicted(spark, gaps):
    settings = impute.Settings(epochs=20)
    out = impute.impute_column(gaps, "number", settings, ignored=["id"])
    assert out.schema["number"].dataType == gaps.schema["number"].dataType and out.columns == gaps.columns
    guesses = filled(gaps, out, "number")
    assert sum(abs(g - i % 3 * 10) <= 2 for i, g in guesses.items()) >= 0.9 * len(guesses)


def test_classes_are_predicted(spark, gaps):
    guesses = filled(gaps, impute.impute_column(gaps, "letter", impute.Settings(epochs=10), ignored=["id"]), "letter")
    assert sum(g == "abc"[i % 3] for i, g in guesses.items()) >= 0.9 * len(guesses)


def test_text_features_are_hashed(spark, gaps):
    out = impute.impute_column(gaps.drop("clue"), "number", impute.Settings(epochs=10), text=["letter"], ignored=["id"])
    filled(gaps, out, "number")
    assert out.where("letter is null").count() == 48  # inputs are not changed


@pytest.mark.parametrize("target", ["number", "letter"])
def test_every_setting_acts(spark, gaps, target):
    """Changing any one setting changes what is predicted, and none has a floor; the rate is that of the trees alone."""
    noisy = gaps.withColumn("number", F.when(F.col("number").isNotNull(), F.col("number") + F.col("id") % 7)).drop("clue")
    noisy = noisy.withColumn("other", (F.col("id") * 37 % 11).cast("double"))
    chance = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.xxhash64("id") % 3 + 3).cast("int") % 3 + 1)
    noisy = noisy.withColumn("letter", F.when(F.col("letter").isNotNull(), chance))
    kind = int if target == "number" else str

    def outcome(**changed):
        settings = impute.Settings(**{"epochs": 2, "hidden": 8, "learning_rate": 0.05, **changed})
        out = impute.impute_column(noisy, target, settings, ignored=["id"])
        return [kind(r[0]) for r in out.orderBy("id").select(target).collect()]

    base = outcome()
    assert outcome() == base
    assert outcome(hidden=64) != base and outcome(epochs=9) != base
    assert (outcome(learning_rate=0.001) != base) == (target == "number")


def test_branch_is_told_and_its_limits_are_arguments(spark, gaps):
    assert impute.imputation_branch(gaps, "clue") == "dense" and impute.imputation_branch(gaps, "hollow") == "hollow"
    assert impute.imputation_branch(gaps, "letter") == "model"
    assert impute.imputation_branch(gaps, "letter", min_training_rows=10_000) == "fallback"
    assert impute.imputation_branch(gaps, "letter", max_classes=2) == "unknown"
    out = impute.impute_column(gaps, "letter", ignored=["id"], max_classes=2)
    assert set(filled(gaps, out, "letter").values()) == {"Unknown"}


def test_parameters_act(spark, examples):
    trials = learn.sample_trials(4)
    assert all(set(t) == set(learn.BOUNDS) <= set(learn.PARAMETERS) for t in trials)
    base = {"n_estimators": 2, "learning_rate": 0.2, "max_depth": 3, "reg_alpha": 0.0, "reg_lambda": 0.0, "min_info_gain": 0.0, "min_instances": 1, "subsample": 1.0}
    training, model = learn.prepare(examples)

    def scores(**changed):
        oof = learn.out_of_fold(training, {**base, **changed}, widest=learn.widest_category(model))
        return [r[0] for r in oof.orderBy("tconst").select("predicted_prob").collect()]

    first = scores()
    changes = [{"min_info_gain": 3.0}, {"min_instances": 60}, {"subsample": 0.5}, {"max_depth": 1}, {"n_estimators": 4}, {"learning_rate": 0.9}, {"reg_alpha": 3.0}, {"reg_lambda": 5.0}]
    for change in changes:
        assert scores(**change) != first, change
    assert set(scores(reg_alpha=1000.0)) == {0.5}
    table = learn.cross_validate(training, [base], learn.widest_category(model))
    assert set(table.columns) == {"trial", *learn.PARAMETERS, "trees", "auc_mean_fold"}


def test_saved_category_map_is_applied(spark, examples):
    training, model = learn.prepare(examples)
    mapping = learn.category_map(model, examples)
    coded = categorical.apply_category_map(examples.select("tconst", "kind"), ["kind"], mapping).collect()
    code = {r["value"]: r["code"] for r in mapping.collect()}
    assert len(coded) == examples.count() and all(r["kind_code"] == code[r["kind"]] for r in coded)


def test_dense_and_hollow_targets_are_left_alone(spark, gaps):
    assert impute.impute_column(gaps, "hollow", ignored=["id"]) is gaps
    assert impute.impute_column(gaps, "clue", ignored=["id"]) is gaps


def test_few_rows_fall_back(spark):
    rows = spark.createDataFrame([(1, "b", 1), (2, "a", 4), (3, "b", 2), (4, None, None), (5, "a", 9)], "id int, t string, n int")
    assert filled(rows, impute.impute_column(rows, "t", ignored=["id"]), "t") == {4: "a"}  # smallest of the most frequent
    assert filled(rows, impute.impute_column(rows, "n", ignored=["id"]), "n") == {4: 3}


def test_many_classes_become_unknown(spark):
    rows = spark.range(1100).select("id", F.when(F.col("id") > 10, F.concat(F.lit("c"), "id")).alias("t"))
    assert set(filled(rows, impute.impute_column(rows, "t", ignored=["id"]), "t").values()) == {"Unknown"}


def test_chain_uses_earlier_fills(spark, gaps):
    out = impute.impute_chain(gaps, ["number", "letter", "absent"], impute.Settings(epochs=3), ignored=["id"])
    assert out.where("number is null or letter is null").count() == 0 and out.count() == 240


def test_null_profile(spark, gaps):
    got = {r["column"]: r["state"] for r in impute.null_profile(gaps).collect()}
    assert got == {"id": "dense", "number": "partial", "letter": "partial", "clue": "dense", "hollow": "hollow"}


# ---------------------------------------------------------------- end to end


def write_titles(path, rows, labelled):
    head = ["", "tconst", "primaryTitle", "originalTitle", "startYear", "endYear", "runtimeMinutes", "numVotes"] + ["label"] * labelled
    lines = [",".join(head)]
    for i in rows:
        start, end = ("\\N", str(1950 + i % 60)) if i % 10 == 0 else (str(1950 + i % 60), "\\N")
        cells = [str(i), f"tt{i}", f'"Title, {i}"', "x", start, end, "\\N" if i % 6 == 0 else f"{80 + i % 40}.0", str(9_999_999 if i == 3 else 100 + i)]
        lines.append(",".join(cells + (["True" if i % 2 else "False"] if labelled else [])))
    path.write_text("\n".join(lines) + "\n")


def test_whole_journey(spark, tmp_path):
    data, work, models, serve = (tmp_path / n for n in ("data", "work", "models", "serve"))
    data.mkdir()
    write_titles(data / "train-1.csv", range(0, 90), True)
    write_titles(data / "train-2.csv", range(90, 180), True)
    order = [190, 185, 189, 181, 186]
    write_titles(data / "test_hidden.csv", order, False)
    for name, role in (("directing", "director"), ("writing", "writer")):
        edges = [{"movie": f"tt{i}", role: f"nm{(i * k) % 17}"} for i in range(0, 192, 1) for k in (1, 3)]
        (data / f"{name}.json").write_text(json.dumps(edges))
    payloads = spark.createDataFrame(
        [(f"tt{i}", json.dumps({"popularity": 9.0 if i % 2 else 1.0, "runtime": 95, "genres": [{"name": "Drama" if i % 2 else "War"}]}) if i % 8 else None) for i in range(192)],
        "tconst string, payload string",
    )
    crew = {"directing": str(data / "directing.json"), "writing": str(data / "writing.json")}
    features = prepare.prepare(spark, f"{data}/train-*.csv", payloads, str(work), **crew)
    assert features.count() == 180 and features.where("runtimeMinutes is null").count() < 30
    assert features.agg(F.max("numVotes")).first()[0] < 9_999_999  # clamped
    assert features.where("startYear is null").count() == 0  # swapped years repaired
    assert {"writer_director_max_collab_weight", "votes_x_popularity", "label"} <= set(features.columns)

    winner = experiments.run_experiments(features, str(models), trials=2, bounds=BOUNDS)
    assert winner["auc_mean_fold"] > 0.9
    assert {"trials", "winner", "model", "category_map", "oof_predictions", "trial_report", "roc_curve", "importance", "misclassified"} <= set(os.listdir(models))
    assert spark.read.parquet(f"{models}/oof_predictions").count() == 180

    titles = f"{data}/test_hidden.csv"
    predictions = inference.score_titles(spark, titles, payloads, str(work), str(models), str(serve), **crew)
    assert predictions.count() == 5
    folder = inference.write_predictions(spark, titles, predictions, str(tmp_path / "submissions"))
    assert os.path.basename(folder).startswith("test_hidden_predictions_")
    parts = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    lines = "".join(open(f"{folder}/{n}").read() for n in parts).split()
    assert lines == ["True" if i % 2 else "False" for i in order]


def test_grid_over_imputer_settings(spark, examples):
    grid = [impute.Settings(epochs=1), impute.Settings(epochs=2)]
    got = experiments.grid_search(examples.drop("hollow"), grid, ["signal"], trials=1, bounds=BOUNDS).collect()
    assert [r["epochs"] for r in got] == [1, 2] and len(experiments.GRID) == 8


def test_finished_fits_are_not_repeated(spark, examples, tmp_path, monkeypatch):
    """A search that is cut off goes on behind its last fit, and ends as one that was not."""
    training, model = learn.prepare(examples)
    options = {"n": 3, "bounds": BOUNDS, "widest": learn.widest_category(model), "batch": 2}
    whole = learn.model_search(training, **options).collect()
    real, fits = learn.fit_trees, []

    def few(*args, **kw):
        fits.append(args[1])
        if len(fits) > 4:
            raise RuntimeError("cut off")
        return real(*args, **kw)

    monkeypatch.setattr(learn, "fit_trees", few)
    monkeypatch.setattr(learn, "ThreadPool", lambda n: Serial())
    with pytest.raises(RuntimeError):
        learn.model_search(training, ledger=f"{tmp_path}/ledger", point="p", **options)
    fits.clear()
    monkeypatch.setattr(learn, "fit_trees", lambda *args, **kw: (fits.append(args[1]), real(*args, **kw))[1])
    assert learn.model_search(training, ledger=f"{tmp_path}/ledger", point="p", **options).collect() == whole
    assert len(fits) == 3 * learn.FOLDS - 4
    fits.clear()
    learn.model_search(training, ledger=f"{tmp_path}/ledger", point="p", **options)
    assert fits == []


class Serial:
    """A pool of one thread."""

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None

    def map(self, function, items, chunksize=1):
        return [function(i) for i in items]


def test_fits_of_a_row_do_not_depend_on_its_batch(spark, gaps, tmp_path):
    """An imputer fitted in training, saved and loaded, fills one row as it fills all."""
    chain, out = impute.fit_chain(gaps, ["number", "letter", "clue"], impute.Settings(epochs=3), ignored=["id"], later=True)
    impute.save_chain(spark, chain, f"{tmp_path}/imputers")
    loaded = impute.load_chain(spark, f"{tmp_path}/imputers")
    assert [(f.target, f.branch) for f in loaded] == [("number", "model"), ("letter", "model"), ("clue", "dense")]
    rows = {r["id"]: r for r in out.collect()}
    assert {r["id"]: r for r in impute.apply_chain(gaps, loaded).collect()} == rows
    one = impute.apply_chain(gaps.where("id = 20"), loaded).collect()
    assert one == [rows[20]] and gaps.where("id = 20 and number is null and letter is null").count() == 1
    lost = impute.apply_chain(gaps.where("id = 1").withColumn("clue", F.lit(None).cast("double")), loaded).first()
    assert lost["clue"] == 1.0  # the median of training


@pytest.mark.parametrize(
    "target, learner, values", [("number", impute.GBTRegressor, 5000), ("letter", impute.MultilayerPerceptronClassifier, 50)]
)
def test_training_rows_are_dealt_by_their_values(spark, gaps, monkeypatch, target, learner, values):
    """Rows that come in one partition do not stay in one."""
    monkeypatch.setattr(impute, "VALUES", values, raising=False)
    seen, real = [], learner.fit
    monkeypatch.setattr(learner, "fit", lambda self, rows: seen.append(rows.rdd.glom().map(len).collect()) or real(self, rows))
    one = gaps.coalesce(1)
    filled(gaps, impute.impute_column(one, target, impute.Settings(epochs=2), ignored=["id"]), target)
    known = gaps.where(F.col(target).isNotNull()).count()
    assert sum(seen[0]) == known and len(seen[0]) > 7 and max(seen[0]) < 30


def test_wide_categories_are_hashed(spark):
    rows = spark.range(2400).select(
        "id", F.concat(F.lit("c"), F.col("id") % 1200).alias("wide"), (F.col("id") % 2).cast("double").alias("clue"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 2 * 10).alias("number"),
    )
    fitted = impute.fit_imputer(rows, "number", impute.Settings(epochs=2), ignored=["id"])
    assert not any(hasattr(s, "labelsArray") for s in fitted.model.stages)
    assert len(fitted.model.transform(impute.prepared_inputs(rows, fitted.inputs, [])).first()["_features"]) == impute.HASH_FEATURES + 1


def test_codes_stay_in_their_table(spark, tmp_path):
    """Many categories: coded by a join, saved, loaded, applied; the driver holds one number per column."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("tconst"), (F.col("id") % 2).cast("int").alias("label"),
        F.concat(F.lit("v"), (F.col("id") % 20_000).cast("string")).alias("many"), F.when(F.col("id") % 3 > 0, (F.col("id") % 2).cast("string")).alias("few"),
    )
    training, pipeline = learn.prepare(rows)
    assert pipeline.stages[0].sizes == [20_000, 3] and learn.widest_category(pipeline) == 4
    model, _ = learn.fit_final(training, pipeline, PARAMS, 32)
    model.write().overwrite().save(f"{tmp_path}/model")
    loaded = PipelineModel.load(f"{tmp_path}/model")
    new = spark.createDataFrame([("a", "v7", "1"), ("b", "never", "0"), ("c", None, None)], "tconst string, many string, few string")
    assert learn.score(loaded, new, "tconst").collect() == learn.score(model, new, "tconst").collect()
    codes = {r["value"]: r["code"] for r in learn.category_map(loaded, rows).where("column = 'many'").collect()}
    assert sorted(codes.values()) == list(range(20_000)) and codes["v0"] == 0 and codes["v1"] == 1
