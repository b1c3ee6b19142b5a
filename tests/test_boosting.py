"""Boosted trees and their search: leaf weights against closed forms, stopping, suggestions."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from footlight.operators import boosting, evaluate, fits, learn, search


@pytest.fixture(scope="module")
def steps(spark):
    """One feature with two values; three quarters of the rows are positive at 1, one quarter at 0."""
    x = (F.col("id") % 2).cast("double")
    label = F.when(x == 1, F.col("id") % 8 != 1).otherwise(F.col("id") % 8 == 0).cast("double")
    return spark.range(160).select("id", array_to_vector(F.array(x)).alias("features"), label.alias("label"), (F.col("id") >= 120).alias("held"))


@pytest.mark.parametrize("alpha, lam", [(0.0, 0.0), (5.0, 0.0), (0.0, 7.0), (3.0, 4.0), (21.0, 1.0)])
def test_leaf_weights_are_penalised_newton_steps(steps, alpha, lam):
    """At margin 0 a leaf of n rows, k of them positive, has G = n / 2 - k and H = n / 4."""
    model = boosting.fit(steps, 1, 0.5, 1, alpha, lam)
    n, k = 80, {0: 20, 1: 60}
    expected = {}
    for x in (0, 1):
        g = n / 2 - k[x]
        expected[x] = -math.copysign(max(abs(g) - alpha, 0), g) / (n / 4 + lam)
    got = model.transform(steps).select("features", "predicted_prob").distinct().collect()
    for r in got:
        assert math.isclose(math.log(r[1] / (1 - r[1])), 0.5 * expected[int(r[0][0])], abs_tol=1e-12)
    assert len(model.trees) == (alpha < 20)


def test_the_ensemble_is_cut_at_its_best_length():
    """A loss that stalls for five trees and then falls keeps the later ones; one that stalls for longer does not."""
    stalls = [0.7, 0.6, 0.6, 0.61, 0.61, 0.6, 0.6, 0.5]
    assert boosting.best_length(stalls, 6) is None and boosting.best_length(stalls, 5) is None
    assert boosting.best_length(stalls[:-1], 5) == 1
    assert boosting.best_length([*stalls, 0.51, 0.52], 2) == 7
    assert boosting.best_length([0.5], 1) is None and boosting.best_length([0.5, 0.6, 0.7], 1) == 1


def test_early_stopping_is_patient(spark):
    """The hold-out rows rise for a while, as they lie where the first trees are wrong, and then fall."""
    r = random.Random(5)
    rows = []
    for i in range(600):
        a, b = r.random(), r.random()
        rows.append(([a, b], float((a > 0.5) != (b > 0.5)) if r.random() < 0.9 else float(r.random() < 0.5), i % 4 == 0))
    table = spark.createDataFrame(rows, "v array<double>, label double, held boolean").select(array_to_vector("v").alias("features"), "label", "held")
    patient = boosting.fit(table, 60, 0.3, 2, holdout="held", patience=15)
    hasty = boosting.fit(table, 60, 0.3, 2, holdout="held", patience=1)
    low = min(range(1, len(patient.losses)), key=lambda i: patient.losses[i])
    assert len(patient.trees) == low and len(patient.losses) <= 61
    assert len(patient.losses) == 61 or len(patient.losses) - 1 - low == 15
    assert len(patient.trees) >= len(hasty.trees) and patient.losses[low] <= min(hasty.losses[1:])
    short = boosting.fit(table, 3, 0.3, 2, holdout="held")
    assert len(short.trees) <= 3 and short.losses == pytest.approx(patient.losses[:4])
    # The loss that decides is that of the hold-out rows under the trees so far.
    held = table.where("held")
    p = patient.cut(5).transform(held).select("label", "predicted_prob").collect()
    assert math.isclose(-sum(math.log(x if y else 1 - x) for y, x in p) / len(p), patient.losses[5], rel_tol=1e-9)


def test_stages_are_saved(spark, steps, tmp_path):
    model = boosting.fit(steps, 12, 0.2, 1)
    whole = PipelineModel(stages=model.stages())
    whole.write().overwrite().save(f"{tmp_path}/model")
    loaded = PipelineModel.load(f"{tmp_path}/model").transform(steps)
    assert loaded.columns == [*steps.columns, "predicted_prob"]
    assert sorted(map(str, loaded.collect())) == sorted(map(str, model.transform(steps).collect())) and len(model.trees) == 12


def test_little_to_learn_from(spark, steps):
    none = boosting.fit(steps.limit(0), 5, 0.1, 2)
    assert none.trees == [] and none.transform(steps).select("predicted_prob").distinct().collect()[0][0] == 0.5
    assert boosting.fit(steps.where("held"), 5, 0.1, 2, holdout="held").trees == []
    assert none.importances == []


def planted(t):
    """Highest at one place of the space."""
    near = [(math.log(t["learning_rate"]) - math.log(0.05)) / 2, (t["max_depth"] - 6) / 4, (t["reg_alpha"] - 5) / 15, (t["reg_lambda"] - 30) / 15]
    return -sum(x * x for x in near)


def test_suggestions_beat_chance():
    won, gain = 0, 0.0
    for seed in range(20):
        done = []
        while len(done) < learn.TRIALS:
            done += [(t, planted(t)) for t in search.suggest(done, learn.BOUNDS, 1, seed)]
        by_chance = max(planted(t) for t in learn.sample_trials(learn.TRIALS, seed))
        found = max(m for _, m in done)
        won, gain = won + (found > by_chance), gain + found - by_chance
    assert won >= 13 and gain > 0


def test_suggestions_keep_to_the_bounds_and_to_the_seed():
    done = [(t, planted(t)) for t in learn.sample_trials(12)]
    sets = search.suggest(done, learn.BOUNDS, 30)
    assert sets == search.suggest(done, learn.BOUNDS, 30) != search.suggest(done, learn.BOUNDS, 30, seed=1)
    assert all(low <= t[k] <= high and isinstance(t[k], type(low)) for t in sets for k, (low, high) in learn.BOUNDS.items())
    assert search.suggest([(t, None) for t, _ in done], learn.BOUNDS, 1)  # trials without a metric come last


@pytest.fixture(scope="module")
def noisy(spark):
    """Two numbers, a category and a label that depends on all three; a tenth of the labels is drawn."""
    r = random.Random(11)
    rows = []
    for i in range(900):
        a, b, c = r.gauss(0, 1), float(r.randrange(9)), float(r.randrange(4))
        label = (a + b / 3 > 1.3) != (c == 2)
        rows.append(([a, b, c], float(label if r.random() < 0.9 else r.random() < 0.5), i % 3, i % 7 == 0))
    frame = spark.createDataFrame(rows, "v array<double>, label double, fold int, is_holdout boolean")
    nominal = {"ml_attr": {"num_attrs": 3, "attrs": {"numeric": [{"idx": 0}, {"idx": 1}], "nominal": [{"idx": 2, "num_vals": 4}]}}}
    return frame.select(array_to_vector("v").alias("features", metadata=nominal), "label", "fold", "is_holdout")


@pytest.mark.parametrize(
    "own",
    [
        {"rounds": 6, "rate": 0.3, "depth": 3, "lam": 1.0},
        {"rounds": 5, "rate": 0.2, "depth": 4, "alpha": 3.0, "lam": 2.0},
        {"rounds": 3, "rate": 0.5, "depth": 4, "min_rows": 20, "min_gain": 0.05},
        {"rounds": 4, "rate": 0.5, "depth": 3, "alpha": 1000.0},
    ],
)
def test_dealt_fits_score_as_single_ones(noisy, own):
    """Number of trees and every score, for each fold, as from ``boosting.fit``."""
    found = {}
    for r in fits.fit_each(noisy, [(fold, own) for fold in range(3)], 32).collect():
        found.setdefault(r["fit"], []).append((r["label"], r["predicted_prob"], r["trees"]))
    for fold in range(3):
        model = boosting.fit(noisy.where(F.col("fold") != fold), holdout="is_holdout", **own)
        want = model.transform(noisy.where(F.col("fold") == fold)).select("label", "predicted_prob").collect()
        got = sorted(found[fold])
        assert [y for y, _, _ in got] == sorted(r[0] for r in want) and {n for _, _, n in got} == {len(model.trees)}
        assert [p for _, p, _ in got] == pytest.approx([p for _, p in sorted(map(tuple, want))], abs=1e-9)


def test_dealt_fits_stop_where_the_loss_is_lowest(noisy):
    """The loss of the hold-out rows rises again; the trees behind its lowest are not scored."""
    own = {"rounds": 80, "rate": 0.9, "depth": 5}
    trees = {r["fit"]: r["trees"] for r in fits.fit_each(noisy, [(0, own), (0, {**own, "rounds": 4})], 32).distinct().collect()}
    assert 1 <= trees[0] < 60 and trees[1] <= 4
    x, y = [], []
    for r in noisy.where("fold != 0").orderBy("is_holdout").collect():
        x.append(r["features"].toArray())
        y.append(r["label"])
    n = noisy.where("fold != 0 and not is_holdout").count()
    behind = len(y) - n
    # Scored on the hold-out rows themselves, the kept number of trees has the lowest loss of all.
    x, y = np.array([*x, *x[n:]]), np.array([*y, *y[n:]])
    loss = {}
    for k in range(1, trees[0] + 21):
        _, m = fits.boosted(x, y, n, 0, {2: 4}, 32, k, 0.9, 5)
        m = m[behind:]
        loss[k] = float(np.mean(np.log1p(np.exp(-np.abs(m))) + np.maximum(m, 0) - y[n + behind :] * m))
    kept, _ = fits.boosted(x, y, n, behind, {2: 4}, 32, **own)
    assert kept == min(loss, key=loss.get)


def test_a_search_takes_one_job_per_batch_not_per_tree(spark, noisy, monkeypatch):
    """The jobs of a search do not depend on the number of trees; a table beyond the bound is not dealt to single tasks."""

    def jobs(rounds):
        group = f"search-{rounds}"
        spark.sparkContext.setJobGroup(group, group)
        found = learn.cross_validate(noisy, [{"n_estimators": rounds, "learning_rate": 0.02, "max_depth": 4}]).collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found[0]["trees"], len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    (few, a), (many, b) = jobs(2), jobs(40)
    assert many > 10 * few and a == b
    seen, real = [], learn.fit_trees
    monkeypatch.setattr(learn, "fit_trees", lambda *args: (seen.append(args[1]), real(*args))[1])
    params = {"n_estimators": 2, "learning_rate": 0.3, "max_depth": 3}
    short = learn.cross_validate(noisy, [params]).collect()
    assert not seen
    monkeypatch.setattr(boosting, "VALUES", 2000)
    plain = learn.cross_validate(noisy, [params]).collect()
    assert len(seen) == learn.FOLDS and plain == short


def test_dealt_fits_without_training_rows(noisy):
    """No trees, even scores; a fold without rows has one line without label."""
    lone = noisy.where("fold = 1")
    got = fits.fit_each(lone, [(1, {"rounds": 3, "rate": 0.1, "depth": 2}), (0, {"rounds": 3, "rate": 0.1, "depth": 2})], 32).collect()
    assert {(r["trees"], r["predicted_prob"]) for r in got if r["fit"] == 0} == {(0, 0.5)} and sum(r["fit"] == 0 for r in got) == 300
    assert [(r["label"], r["trees"] > 0) for r in got if r["fit"] == 1] == [(None, True)]


def test_areas_are_those_of_the_scores(noisy):
    """One row per fit, told by its task: trees and area as ``roc_auc`` finds them in the scores; none without a class."""
    each = [(fold, {"rounds": 4, "rate": 0.3, "depth": 2 + fold, "alpha": 2.0}) for fold in range(3)]
    scores = fits.fit_each(noisy, each, 32)
    want = {r["fit"]: r["auc"] for r in evaluate.roc_auc(scores, "label", "predicted_prob", by=("fit",)).collect()}
    trees = {r["fit"]: r["trees"] for r in scores.collect()}
    assert {r["fit"]: (r["trees"], r["auc"]) for r in fits.area_each(noisy, each, 32).collect()} == {k: (trees[k], want[k]) for k in want}
    lone = noisy.where("fold = 1 or label = 1")
    assert [r["auc"] is None for r in fits.area_each(lone, each, 32).orderBy("fit").collect()] == [True, False, True]
    assert fits.area([0.0, 1.0, 1.0, 0.0], [0.1, 0.1, 0.4, 0.2]) == 0.625


@pytest.mark.parametrize("min_rows", [1, 7])
def test_nodes_that_the_penalty_outweighs_are_not_split(min_rows):
    """No row gets another weight than from the whole tree, which has more leaves."""
    r = np.random.default_rng(5)
    codes = r.integers(0, 16, (4, 900))
    codes[3] %= 5
    g, h = r.normal(0, 0.4, 700), r.uniform(0.01, 0.25, 700)
    g[codes[0, :700] > 11] += 0.3

    def weights(alpha, pruned):
        leaf = fits.grow(codes, g, h, 16, {3: 5}, 9, 0.0, min_rows, alpha if pruned else 0.0, fits.Room())
        total = np.bincount(leaf[:700], g)
        own = np.copysign(np.maximum(np.abs(total) - alpha, 0), total) / (np.bincount(leaf[:700], h) + 1)
        return own[leaf], len(total)

    for alpha in (1.0, 4.0, 9.0):
        (some, few), (whole, many) = weights(alpha, True), weights(alpha, False)
        assert np.array_equal(np.abs(some), np.abs(whole)) and few <= many
    assert few < many and np.any(weights(4.0, True)[0])


def test_the_first_trials_of_a_search_are_one_batch(spark, noisy):
    """They look at no others: as many jobs as one batch, one fit to a task, and the trials that smaller batches find."""
    bounds = {"max_depth": (2, 3), "learning_rate": (0.1, 0.3), "n_estimators": (2, 4)}

    def searched(batch, n):
        group = f"first-{batch}-{n}"
        spark.sparkContext.setJobGroup(group, group)
        found = learn.model_search(noisy, n, bounds, batch=batch)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found.collect(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    (small, a), (large, b), (one, c) = searched(2, search.STARTUP), searched(search.STARTUP, search.STARTUP), searched(1, 1)
    assert small == large and a == b == c and one == large[:1]
    dealt = fits._dealt(noisy, [(0, {})] * 12).applyInArrow(lambda t: t.select(["fit"]).slice(0, 1), "fit int")
    places = [r[0] for r in dealt.select(F.spark_partition_id()).collect()]
    assert len(set(places)) == len(places) == 12


def plain_weights(codes, g, h, depth, min_rows, kinds):
    """Sum of gradients over that of curvature in the leaf of each row; every split tried by itself on all rows of its node."""
    out, nodes = np.zeros(codes.shape[1]), [(np.arange(codes.shape[1]), depth)]
    while nodes:
        rows, left = nodes.pop()
        own = rows[rows < len(g)]
        total, best = g[own].sum() ** 2 / h[own].sum(), (0.0, None)
        for f in range(len(codes) if left else 0):
            there = sorted(set(codes[f, own]))
            if f in kinds:
                there.sort(key=lambda c: -g[own][codes[f, own] == c].sum() / h[own][codes[f, own] == c].sum())
            for k in range(1, len(there)):
                side = np.isin(codes[f, own], there[:k])
                if min(side.sum(), (~side).sum()) >= min_rows:
                    gain = sum(g[own][s].sum() ** 2 / h[own][s].sum() for s in (side, ~side)) - total
                    best = max(best, (gain, (f, there[:k])), key=lambda b: b[0])
        if best[1] is None or best[0] < 1e-9 * h[own].sum():
            out[rows] = g[own].sum() / h[own].sum()
            continue
        side = np.isin(codes[best[1][0], rows], best[1][1])
        nodes += [(rows[side], left - 1), (rows[~side], left - 1)]
    return out


@pytest.mark.parametrize("min_rows, few", [(1, 1 << 12), (9, 1 << 12), (1, 16)])
def test_features_summed_in_groups_give_the_same_tree(monkeypatch, min_rows, few):
    """As every split tried by itself; in any order of the rows; with a pass of half the rows per feature and level at most."""
    monkeypatch.setattr(fits, "FEW", few)
    r = np.random.default_rng(3)
    codes = r.integers(0, 16, (5, 20000)).astype(np.uint8)
    codes[3], codes[4] = r.integers(0, 6, 20000), np.minimum(codes[4], 1)
    g, h = r.normal(0, 0.4, 20000), r.uniform(0.01, 0.25, 20000)
    g += np.where((codes[0] > 11) == np.isin(codes[3], (1, 4)), 0.2, -0.1)
    passed, real = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *args, **kw: (passed.append(len(x)), real(x, *args, **kw))[1])
    leaf = fits.grow(codes, g, h, 16, {3: 6}, 6, 0.0, min_rows, 0.0, fits.Room()).copy()
    assert sum(passed) < 0.5 * 6 * 5 * (2 + (min_rows > 1)) * 20000
    monkeypatch.setattr(np, "bincount", real)
    want = plain_weights(codes, g, h, 6, min_rows, {3})
    assert (real(leaf, g) / real(leaf, h))[leaf] == pytest.approx(want, rel=1e-9)
    turn = r.permutation(20000)
    other = fits.grow(codes[:, turn], g[turn], h[turn], 16, {3: 6}, 6, 0.0, min_rows, 0.0, fits.Room())
    assert len(set(zip(leaf[turn], other))) == len(set(leaf)) == len(set(other))


def test_sums_on_the_grid_do_not_depend_on_the_order():
    r = np.random.default_rng(4)
    for values in (r.normal(0, 1, 5000), r.uniform(0, 1e-6, 3000), np.array([0.75, -1e-9]), np.zeros(3)):
        on = fits.exact(values, np.empty(len(values)))
        assert np.max(np.abs(on - values)) <= 2.0**-52 * max(np.sum(np.abs(values)), 1e-300)
        assert np.cumsum(on)[-1] == math.fsum(on) == np.cumsum(on[::-1])[-1]


def test_groups_of_features_keep_to_their_cells():
    got = fits.grouped([32, 32, 5, 32, 21], 1024)
    assert sorted(f for group in got for f in group) == [0, 1, 2, 3, 4] and len(got) == 3
    assert all(math.prod([32, 32, 5, 32, 21][f] for f in group) <= 1024 for group in got)
    assert fits.grouped([9, 4], 0) == [(0,), (1,)]


def test_tables_of_a_million_rows_are_dealt(spark, noisy):
    """1.3 million rows of 7 features are; 3 million are not.  Rows cross the network in batches of bytes."""

    def wide(n):
        return spark.range(n).select(array_to_vector(F.array(*[F.col("id").cast("double")] * 7)).alias("features"))

    assert fits.bounded(wide(1_300_000)) and not fits.bounded(wide(3_000_000))
    sent = fits._dealt(noisy, [(0, {})] * 3).applyInArrow(lambda t: t.select(["fit"]), "fit int").count()
    assert sent <= 3 * noisy.rdd.getNumPartitions()
