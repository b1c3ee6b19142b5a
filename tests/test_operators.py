import math
import os
import random
from collections import Counter, defaultdict
from functools import partial
from itertools import combinations, product
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footlight import session
from footlight.operators import categorical, drift, enrich, evaluate, folds, graph, ordering, outliers, skew, stats
from footlight.session import materialise, scratch_dir

# ---------------------------------------------------------------- joins and order statistics


@pytest.mark.parametrize("limit", [10**9, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_hot_and_null_keys(spark, limit, how):
    keys = ["hot"] * 700 + [f"k{i}" for i in range(200)] + [None] * 100
    facts = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    counted = Counter(k for k in keys if k)
    table = materialise(spark.createDataFrame([(k, k.upper(), n) for k, n in counted.items() if k != "k7"], "k string, v string, n long"), "t")
    got = skew.lookup_join(facts, table, ["k"], weight="n", how=how, broadcast_bytes=limit, hot_share=10)
    rows = sorted((r["i"], r["v"]) for r in got.select("i", F.coalesce("v", F.lit("-")).alias("v")).collect())
    want = [(i, "-" if k in (None, "k7") else k.upper()) for i, k in enumerate(keys)]
    assert rows == [w for w in want if how == "left" or w[1] != "-"]
    assert set(got.columns) == {"k", "i", "v", "n"}


def test_estimated_bytes_counts_strings(spark):
    assert skew.estimated_bytes(spark.createDataFrame([("x" * 1000, 1)] * 3, "a string, b int")) > 3000


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_quantiles_are_exact(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rng = random.Random(1)
        values = [rng.choice([0.0, rng.gauss(0, 50), float(round(rng.expovariate(0.1)))]) for _ in range(701)]
        df = spark.createDataFrame([(v, i % 5 if i % 3 else None, None) for i, v in enumerate(values)], "v double, w long, x double")
        fractions = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
        got = {(r["column"], r["fraction"]): r["value"] for r in ordering.quantiles(df, ["v", "w", "x"], fractions).collect()}
        ordered = sorted(values)
        assert all(got["v", f] == ordered[max(math.ceil(f * 701), 1) - 1] for f in fractions)
        assert not any(c == "x" for c, _ in got)
        smooth = {(r["column"], r["fraction"]): r["value"] for r in ordering.quantiles(df, ["v", "w"], fractions, True).collect()}
        for f in fractions:
            assert smooth["v", f] == pytest.approx(np.quantile(values, f))
            assert smooth["w", f] == pytest.approx(np.quantile([i % 5 for i in range(701) if i % 3], f))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sorted_positions_in_buckets(spark):
    values = sorted({f"v{random.Random(i).randint(0, 10**6)}" for i in range(900)})
    df = spark.createDataFrame([(v,) for v in values], "value string").repartition(5)
    for one_bucket in (10_000, 100):
        got = {r["value"]: r["code"] for r in ordering.sorted_positions(df, "value", one_bucket).collect()}
        assert got == {v: i for i, v in enumerate(values)}


def session_with(setting, master):
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=context)


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_dir(session_with("hdfs://shared/ck/", "yarn")) == "hdfs://shared/ck/footlight-app-1"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_with(None, "yarn"))
    assert scratch_dir(session_with(None, "local[2]")) == scratch_dir(session_with(None, "local[2]"))
    assert materialise(spark.range(5), "t").count() == 5


# ---------------------------------------------------------------- outliers


def mad_reference(values, k):
    known = sorted(v for v in values if v is not None)
    median = known[max(math.ceil(len(known) / 2), 1) - 1]
    gaps = sorted(abs(v - median) for v in known)
    mad = gaps[max(math.ceil(len(known) / 2), 1) - 1]
    return median, mad, median - k * 1.4826 * mad, median + k * 1.4826 * mad


def test_mad_clamp_many_columns(spark):
    ints = [1, 2, 3, 4, 5, 100, -100, None, 4]
    reals = [float(i) if i is not None else None for i in ints]
    rows = [(i, r, 7, None if j else 1) for j, (i, r) in enumerate(zip(ints, reals))]
    df = spark.createDataFrame(rows, "i int, r double, constant int, single int")
    bounds = outliers.fit_bounds(df, ["i", "r", "constant", "single"], 2.0)
    median, mad, low, high = mad_reference(ints, 2.0)
    by = {b.column: b for b in bounds}
    assert (by["i"].median, by["i"].mad, by["i"].lower, by["i"].upper) == (median, mad, low, high)
    assert by["constant"].lower is None and by["single"].lower is None and by["single"].n == 1
    out = outliers.clamp(df, bounds)
    assert out.dtypes == df.dtypes
    got = [tuple(r) for r in out.collect()]
    assert [g[0] for g in got] == [None if v is None else int(low) if v < low else int(high) if v > high else v for v in ints]
    assert [g[1] for g in got] == [None if v is None else min(max(v, low), high) for v in reals]
    assert [g[2:] for g in got] == [r[2:] for r in rows]
    report = {r["column"]: r["n_clamped"] for r in outliers.clamp_report(df, bounds).collect()}
    assert report == {"i": 2, "r": 2, "constant": 0, "single": 0}
    assert outliers.load_bounds(outliers.bounds_table(spark, bounds)) == bounds
    sketched = outliers.fit_bounds(df, ["i", "r", "constant", "single"], 2.0, exact=False)
    assert sketched == bounds


def test_default_columns_leave_the_label_alone(spark):
    df = spark.createDataFrame([(1, 2, "x")], "a int, label int, b string")
    assert outliers.integer_columns(df) == ["a"]


# ---------------------------------------------------------------- graph


def brute_same(edges):
    titles = defaultdict(list)
    for t, p in edges:
        if t is not None and p is not None:
            titles[t].append(p)
    pairs = [(t, *sorted(pq)) for t, ps in titles.items() for pq in combinations(ps, 2) if pq[0] != pq[1]]
    weight = Counter((a, b) for _, a, b in pairs)
    best = defaultdict(int)
    for t, a, b in pairs:
        best[t] = max(best[t], weight[a, b])
    return dict(best), Counter(t for t, _, _ in pairs)


def brute_cross(a, b):
    left, right = defaultdict(list), defaultdict(list)
    for t, p in a:
        left[t].append(p)
    for t, p in b:
        right[t].append(p)
    pairs = [(t, p, q) for t in left if t in right for p, q in product(left[t], right[t]) if None not in (t, p, q)]
    weight = Counter((p, q) for _, p, q in pairs)
    best = defaultdict(int)
    for t, p, q in pairs:
        best[t] = max(best[t], weight[p, q])
    return dict(best), Counter(t for t, _, _ in pairs)


def random_edges(seed, titles=30, people=14, n=260, hot=0.35):
    rng = random.Random(seed)
    edges = []
    for _ in range(n):
        t = 0 if rng.random() < hot else rng.randrange(titles)
        edges.append((f"t{t}", f"p{min(rng.randrange(people), rng.randrange(people)):02d}"))
    return edges + [("t1", None), (None, "p01"), ("alone", "p03"), ("same", "p04"), ("same", "p04")]


def relation(spark, edges):
    return spark.createDataFrame(edges, "tconst string, nconst string")


@pytest.mark.parametrize("crowd", [1, 4, 12, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_pair_weights_agree_with_listing_all_pairs(spark, crowd, seed):
    a, b = random_edges(seed), random_edges(seed + 100, hot=0.3)
    same = graph.same_role_weight(relation(spark, a), "w", crowd=crowd)
    assert {r[0]: r[1] for r in same.collect()} == brute_same(a)[0]
    cross = graph.cross_role_weight(relation(spark, a), relation(spark, b), "w", "d", crowd=crowd)
    assert {r[0]: r[1] for r in cross.collect()} == brute_cross(a, b)[0]


def test_refined_buckets_agree_with_listing_all_pairs(spark, monkeypatch):
    """Chance overlaps over many titles: buckets go through several rounds, and large ones are cut into parts."""
    monkeypatch.setattr(graph, "FEW_PAIRS", 0)
    monkeypatch.setattr(graph, "TASK_PAIRS", 5)
    monkeypatch.setattr(graph, "MOST_TASKS", 4)
    rounds, kept = [], graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, name: rounds.append(name) or kept(df, name))
    rng = random.Random(3)
    edges = [(f"t{t}", f"p{p}") for p in range(150) for t in rng.choices(range(25), k=5)]
    same = graph.same_role_weight(relation(spark, edges), "w", crowd=1)
    assert {r[0]: r[1] for r in same.collect()} == brute_same(edges)[0]
    assert rounds.count("crowd_refined") > 0


def test_crowds_of_hundreds_are_compared_at_once(spark, monkeypatch):
    """Chance overlaps of few people a title: one round of tiles, though a bucket has several."""
    monkeypatch.setattr(graph, "TASK_PAIRS", 256)
    rounds, kept = [], graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, name: rounds.append(name) or kept(df, name))
    rng = random.Random(4)
    a = [(f"t{t}", f"p{p}") for p in range(150) for t in rng.choices(range(12), k=4)]
    b = [(f"t{t}", f"p{p}") for p in range(20) for t in rng.choices(range(12), k=14)]
    cross = graph.cross_role_weight(relation(spark, a), relation(spark, b), "w", "d", crowd=1)
    assert {r[0]: r[1] for r in cross.collect()} == brute_cross(a, b)[0]
    same = graph.same_role_weight(relation(spark, a), "w", crowd=1)
    assert {r[0]: r[1] for r in same.collect()} == brute_same(a)[0]
    assert rounds.count("crowd_buckets") == 2 and "crowd_refined" not in rounds


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("block", [3, 1 << 20])
def test_a_tile_weighs_all_its_pairs(monkeypatch, same, block):
    monkeypatch.setattr(graph, "BLOCK", block)
    rng = random.Random(block)
    rows = []
    for _ in range(30):
        tail = {f"t{rng.randrange(9)}": rng.randrange(1, 4) for _ in range(rng.randrange(5))}
        rows.append({"role": 2 if same else rng.randrange(2), "bucket": ["x"], "counts": [rng.randrange(1, 4)], "tails": list(tail), "tail_counts": list(tail.values())})
    pairs = combinations(rows, 2) if same else product(*[[r for r in rows if r["role"] == k] for k in (0, 1)])
    best = defaultdict(int)
    for p, q in pairs:
        other = dict(zip(q["tails"], q["tail_counts"]))
        met = {t: m * other[t] for t, m in zip(p["tails"], p["tail_counts"]) if t in other}
        for t in [*met, *["x"] * bool(met)]:
            best[t] = max(best[t], p["counts"][0] * q["counts"][0] + sum(met.values()))
    kinds = pa.schema([("role", pa.int32()), ("bucket", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("tails", pa.list_(pa.string())), ("tail_counts", pa.list_(pa.int64()))])
    got = graph._tile(pa.Table.from_pylist(rows, kinds))
    assert dict(zip(*[c.to_pylist() for c in got.columns])) == best


@pytest.mark.parametrize("hot_share", [1, 9])
def test_pairs_of_small_titles_cross_the_network_once(spark, monkeypatch, hot_share):
    """No pair is looked up but those of two hot people."""
    monkeypatch.setattr(graph, "HOT_SHARE", hot_share, raising=False)
    names, kept = [], graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, name: names.append(name) or kept(df, name))
    a, b = random_edges(5, people=20), random_edges(6, people=20)
    same = graph.same_role_weight(relation(spark, a), "w", crowd=10_000)
    assert {r[0]: r[1] for r in same.collect()} == brute_same(a)[0]
    cross = graph.cross_role_weight(relation(spark, a), relation(spark, b), "w", "d", crowd=10_000)
    assert {r[0]: r[1] for r in cross.collect()} == brute_cross(a, b)[0]
    assert hot_share > 1 or "recurring_pairs" not in names


def test_crowd_of_distinct_people(spark):
    """Large titles with many people: two share a core that also meets in a third."""
    edges = [("big", f"x{i}") for i in range(400)] + [("big2", f"x{i}") for i in range(390, 700)] + [("small", "x391"), ("small", "x395")]
    got = graph.same_role_weight(relation(spark, edges), "w", crowd=50)
    assert {r[0]: r[1] for r in got.collect()} == {"big": 3, "big2": 3, "small": 3}


def test_pair_counts(spark):
    a, b = random_edges(5), random_edges(6)
    assert {r[0]: r[1] for r in graph.same_role_pair_counts(relation(spark, a)).collect()} == brute_same(a)[1]
    with_nulls = Counter(t for t, _ in a if t)
    other = Counter(t for t, _ in b if t)
    got = {r[0]: r[1] for r in graph.cross_role_pair_counts(relation(spark, a), relation(spark, b)).collect()}
    assert got == {t: with_nulls[t] * other[t] for t in with_nulls if t in other}


def test_degree_features_count_repeats_unless_deduplicated(spark):
    edges = [("a", "p"), ("a", "p"), ("b", "p"), ("b", "q"), ("c", None)]
    got = {r[0]: (r[1], r[2]) for r in graph.degree_features(relation(spark, edges), "d").collect()}
    assert got == {"a": (3.0, 2), "b": (2.0, 2), "c": (None, 0)}
    once = {r[0]: (r[1], r[2]) for r in graph.degree_features(relation(spark, edges), "d", dedupe=True).collect()}
    assert once == {"a": (2.0, 1), "b": (1.5, 2), "c": (None, 0)}


def test_feature_matrix_keeps_titles_and_skips_absent_relations(spark):
    titles = spark.createDataFrame([("a",), ("b",), ("z",)], "tconst string")
    edges = relation(spark, [("a", "p"), ("a", "q"), ("b", "p")])
    full = graph.feature_matrix(titles, edges, edges)
    assert full.columns == ["tconst", "director_avg_centrality", "director_count", "writer_avg_centrality", "writer_count", "writer_writer_max_collab_weight", "writer_director_max_collab_weight"]
    rows = {r["tconst"]: r for r in full.collect()}
    assert len(rows) == 3 and set(rows["z"].asDict().values()) == {"z", None}
    assert rows["a"]["writer_writer_max_collab_weight"] == 1 and rows["b"]["writer_writer_max_collab_weight"] is None
    assert graph.feature_matrix(titles, edges, None).columns == full.columns[:3]
    assert graph.feature_matrix(titles).columns == ["tconst"]


# ---------------------------------------------------------------- categories and enrichment


def test_vocabulary_places_unknown(spark):
    rows = spark.createDataFrame([("b",)] * 3 + [("a",)] + [("zz",)] * 2, "v string")
    plain = {r["value"]: r["code"] for r in categorical.fit_vocabulary(rows, "v").collect()}
    assert plain == {"a": 0, "b": 1, "zz": 2, "unknown": 3}
    rare = {r["value"]: (r["code"], r["n"]) for r in categorical.fit_vocabulary(rows, "v", 2).collect()}
    assert rare == {"b": (0, 3), "unknown": (1, 1), "zz": (2, 2)}


def test_vocabulary_applies_to_new_values(spark):
    train = spark.createDataFrame([("Sci-Fi",), ("sci fi",), (None,), ("Drama",)], "v string")
    fitted, vocabulary = categorical.normalise_category(train, "v")
    assert sorted(r[0] for r in fitted.collect()) == ["drama", "fi sci", "scifi", "unknown"]
    serve = spark.createDataFrame([("DRAMA!",), ("Western",), ("",), (None,)], "v string")
    applied, _ = categorical.normalise_category(serve, "v", vocabulary)
    assert sorted(r[0] for r in applied.collect()) == ["drama", "unknown", "unknown", "unknown"]
    unseen = categorical.unseen_values(spark.createDataFrame([("drama",), ("western",), ("western",)], "v string"), "v", vocabulary)
    assert [tuple(r) for r in unseen.collect()] == [("western", 2)]


def test_codes_and_maps(spark):
    rows = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert sorted(map(tuple, categorical.category_codes(rows, "v", "c").collect()), key=str) == sorted([("b", 1), ("a", 0), (None, -1), ("b", 1)], key=str)
    mapping = spark.createDataFrame([("v", "a", 0, 1), ("v", "Unknown", 1, 1)], "column string, value string, code int, n long")
    got = sorted(map(tuple, categorical.apply_category_map(rows, ["v"], mapping).collect()), key=str)
    assert got == sorted([("b", None), ("a", 0), ("Unknown", 1), ("b", None)], key=str)


def test_enrichment(spark):
    titles = spark.createDataFrame([("a", None, 10), ("b", 90, None), ("c", None, 5), (None, 1, 1)], "tconst string, runtimeMinutes int, numVotes int")
    extra = spark.createDataFrame(
        [("a", 100, 2.0, 10.0, 0.0, "Drama", True), ("b", 80, 3.0, 10.0, 4.0, None, True)],
        "tconst string, tmdb_runtime int, tmdb_popularity double, tmdb_budget double, tmdb_revenue double, tmdb_primary_genre string, tmdb_success boolean",
    )
    out, vocabularies = enrich.enrich_titles(titles, extra)
    rows = {r["tconst"]: r for r in out.collect()}
    assert len(rows) == 4 and "tmdb_runtime" not in out.columns
    assert [rows[k]["runtimeMinutes"] for k in ("a", "b", "c")] == [100, 90, None]
    assert [rows[k]["votes_x_popularity"] for k in ("a", "b", "c")] == [20.0, 0.0, 0.0]
    assert [rows[k]["budget_revenue_ratio"] for k in ("a", "b", "c")] == [0.0, 2.5, 0.0]
    assert [rows[k]["tmdb_primary_genre"] for k in ("a", "b", "c")] == ["drama", "unknown", "unknown"]
    assert {r["value"] for r in vocabularies.collect()} == {"drama", "unknown"}
    again, _ = enrich.enrich_titles(titles, extra.withColumn("tmdb_primary_genre", F.lit("Opera")), vocabularies)
    assert {r["tmdb_primary_genre"] for r in again.collect()} == {"unknown"}
    assert sorted(r[0] for r in enrich.missing_keys(titles, extra).collect()) == ["c"]
    assert sorted(r[0] for r in enrich.missing_keys(titles, None).collect()) == ["a", "b", "c"]
    assert tuple(enrich.coverage(extra).first()) == (2, 2, 1.0)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


def test_left_joins_split_null_and_hot_keys(spark, monkeypatch):
    """Both left joins are one shuffled join, whose partitions of null and of hot keys are dealt to several tasks."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
    titles = spark.range(0, 60000, 1, 8).select(key.alias("tconst"), F.md5(F.col("id").cast("string")).alias("name"))
    extra = materialise(titles.select("tconst").where("tconst is not null").distinct().withColumn("tmdb_budget", F.length("tconst")), "extra")
    monkeypatch.setattr(graph, "lookup_join", partial(skew.lookup_join, broadcast_bytes=0))
    crew = extra.select("tconst", F.col("tconst").alias("nconst"))
    try:
        for k, v in SKEW.items():
            spark.conf.set(k, v)
        for out, column in ((enrich.enrich(titles, extra), "tmdb_budget"), (graph.feature_matrix(titles, crew), "director_count")):
            rows = out.select("tconst", "name", column).toArrow().to_pandas()
            assert len(rows) == 60000 and rows["name"].nunique() == 60000
            assert rows.loc[rows["tconst"] == "hot", column].notna().all() and rows.loc[rows["tconst"].isna(), column].isna().all()
            out.collect()
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


# ---------------------------------------------------------------- statistics


@pytest.mark.parametrize("few_values", [stats.FEW_VALUES, 4, 0])
def test_spearman_with_nulls_matches_pandas(spark, monkeypatch, few_values):
    """Ranks looked up, ordered in buckets, and both."""
    monkeypatch.setattr(stats, "FEW_VALUES", few_values)
    rng = random.Random(3)
    frame = pd.DataFrame(
        {
            "a": [rng.randrange(6) for _ in range(200)],
            "b": [rng.gauss(0, 1) for _ in range(200)],
            "c": [rng.gauss(0, 1) if rng.random() < 0.7 else None for _ in range(200)],
            "d": [rng.randrange(3) if rng.random() < 0.6 else None for _ in range(200)],
            "const": [1] * 200,
            "hollow": [None] * 200,
        }
    )
    frame["e"] = frame["a"] * 2
    frame["hot"] = [0.0 if i % 3 else rng.choice([-1.5, -0.0, 2.5, 1e308, -1e308]) for i in range(200)]
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame.columns))
    got = {(r["x"], r["y"]): r["rho"] for r in stats.spearman_matrix(df, list(frame.columns)).collect()}
    assert len(got) == len(frame.columns) ** 2
    for x, y in product(frame.columns, repeat=2):
        both = frame[[x, y]].dropna().astype(float) if x != y else frame[[x]].dropna().astype(float)
        if both.empty or (both.nunique() < 2).any():
            assert got[x, y] is None
        else:
            want = np.corrcoef(both[x].rank(), both[y].rank())[0, 1] if x != y else 1.0
            assert got[x, y] == pytest.approx(want, abs=1e-12)
    pairs = [tuple(r) for r in stats.collinear_pairs(df, ["a", "b", "e"], 0.75).collect()]
    assert [p[:2] for p in pairs] == [("a", "e")] and pairs[0][2] == pytest.approx(1.0)  # perfect pairs are reported


def test_spearman_cells_per_task_are_bounded(spark, monkeypatch):
    """More cells get more tasks, whatever the number of shuffle partitions, and the same result."""
    monkeypatch.setattr(stats, "FEW_VALUES", 0)
    rng = random.Random(9)
    df = spark.createDataFrame([(rng.random(), rng.gauss(0, 1), rng.random()) for _ in range(1500)], "a double, b double, c double")
    want = sorted(map(tuple, stats.spearman_pairs(df, df.columns).collect()))
    monkeypatch.setattr(stats, "CELLS", 200, raising=False)
    found = stats.spearman_pairs(df, df.columns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 23), REPARTITION_BY_NUM") == 2
    got = sorted(map(tuple, found.collect()))
    assert [r[:2] for r in got] == [r[:2] for r in want] and [r[2] for r in got] == pytest.approx([r[2] for r in want], abs=1e-12)


def test_spearman_ranks_many_columns_in_one_exchange(spark, monkeypatch):
    """The plan has two exchanges of cells (values, ranks back to rows) for any number of columns; a hot value stays in place."""
    monkeypatch.setattr(stats, "FEW_VALUES", 0)
    rng = random.Random(5)
    data = [tuple(7.0 if rng.random() < 0.4 else rng.random() for _ in range(7)) for _ in range(2000)]
    df = spark.createDataFrame(data, ", ".join(f"v{i} double" for i in range(7)))
    plans = []
    for n in (2, 7):
        found = stats.spearman_pairs(df, [f"v{i}" for i in range(n)])
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        assert found.count() == n * (n - 1) // 2
    for plan in plans:
        assert plan.count("Exchange hashpartitioning(column") == 1 and plan.count("Exchange hashpartitioning(_row") == 1
        assert plan.count("Exchange ") - plan.count("BroadcastExchange ") == 3  # and the one row of sums
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    moved = stats._cell_ranks(rows, ["v0"], [])
    ranks = sorted(r[0] for r in moved.select("rank0").collect())
    assert ranks == sorted(pd.Series([r[0] for r in data]).rank())
    assert stats._split_cuts(df, ["v0"], 8)["v0"][-2:] == [7.0, math.nextafter(7.0, math.inf)]


def label_rows(spark, table):
    rows = [(c, y) for c, (n0, n1) in table.items() for y, n in ((0, n0), (1, n1)) for _ in range(n)]
    return spark.createDataFrame(rows, "c string, y int")


def test_chi_squared_corrects_small_tables(spark):
    # Two by two: |o - e| = 2.5 everywhere, minus one half by Yates.
    got = stats.chi_squared(label_rows(spark, {"a": (10, 5), "b": (5, 10)}), "c", "y").first()
    assert got["dof"] == 1 and got["statistic"] == pytest.approx(4 * 2.0**2 / 7.5)
    assert got["p_value"] == pytest.approx(math.erfc(math.sqrt(got["statistic"] / 2)))
    assert got["cramers_v"] == pytest.approx(math.sqrt(got["statistic"] / 30))
    wide = stats.chi_squared(label_rows(spark, {"a": (10, 5), "b": (5, 10), "c": (3, 3)}), "c", "y").first()
    assert wide["dof"] == 2 and wide["p_value"] == pytest.approx(math.exp(-wide["statistic"] / 2))
    one = stats.chi_squared(label_rows(spark, {"a": (10, 0), "b": (5, 0)}), "c", "y").first()
    assert (one["statistic"], one["dof"], one["p_value"], one["cramers_v"]) == (0.0, 0, 1.0, 0.0)


def test_upper_tail():
    assert stats._upper_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert stats._upper_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert stats._upper_tail(0.0, 3) == 1.0 and stats._upper_tail(500.0, 3) < 1e-100


def test_small_groups_are_left_out(spark):
    got = stats.group_positive_rate(label_rows(spark, {"a": (5, 5), "b": (2, 9), "tiny": (1, 1)}), "c", "y").collect()
    assert [(r["c"], r["n"]) for r in got] == [("a", 10), ("b", 11)]


# ---------------------------------------------------------------- evaluation


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_published_counts_give_the_published_rates(spark):
    counts = spark.createDataFrame([(3831, 171, 3798, 159)], "tp long, fp long, tn long, fn long")
    got = evaluate.rates(counts).first()
    want = {"accuracy": 0.9585375047116472, "precision": 0.9572713643178411, "sensitivity": 0.9601503759398496, "specificity": 0.9569160997732427}
    assert {k: got[k] for k in want} == pytest.approx(want)


def test_metrics_at_the_edges(spark):
    got = evaluate.classification_metrics(scored(spark, [(1, 0.5), (1, 0.4)]), "label", "score").first()
    assert (got["tp"], got["fn"], got["precision"], got["specificity"]) == (1, 1, 1.0, 0.0)
    assert evaluate.roc_auc(scored(spark, [(1, 0.5), (1, 0.4)]), "label", "score").first()[0] is None


def test_auc_counts_ties_half(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(2), round(rng.random(), 1)) for _ in range(150)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = scored(spark, rows)
    assert evaluate.roc_auc(df, "label", "score").first()[0] == pytest.approx(want)
    flipped = df.withColumn("score", -F.col("score"))
    assert evaluate.roc_auc(flipped, "label", "score").first()[0] == pytest.approx(1 - want)
    curve = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df, "label", "score").collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    assert curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0) and area == pytest.approx(want)


def test_auc_per_group(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.2), ("b", 0, 0.8)]
    df = spark.createDataFrame(rows, "fold string, label int, score double")
    assert {r[0]: r[1] for r in evaluate.roc_auc(df, "label", "score", by=("fold",)).collect()} == {"a": 1.0, "b": 0.0}


def test_predictions_follow_the_input(spark):
    keys = spark.createDataFrame([("c", 0), ("a", 1), ("b", 2)], "k string, pos int")
    predictions = spark.createDataFrame([("a", 1), ("c", 0)], "k string, predicted_label int")
    got = evaluate.ordered_predictions(keys, predictions, "k", ["pos"]).orderBy("pos").collect()
    assert [r["prediction"] for r in got] == ["False", "True", "False"]


def test_alignment_fills_absent_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "b int, a double")
    got = evaluate.align_features(df, ["a", "gone", "b"])
    assert got.columns == ["a", "gone", "b"] and tuple(got.first()) == (2.0, 0, 1)


# ---------------------------------------------------------------- drift


def sample(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


def ks_reference(a, b):
    grid = sorted(set(a) | set(b))
    return max(abs(sum(x <= g for x in a) / len(a) - sum(x <= g for x in b) / len(b)) for g in grid)


def psi_reference(expected, actual, q):
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, q + 1)))
    place = lambda v: np.where(v == edges[0], 1, np.searchsorted(edges, v, side="left"))
    e, a = place(np.array(expected)), place(np.array(actual))
    e, a = ([np.sum(s == i) for i in range(1, len(edges))] for s in (e, a))
    e, a = (np.where(np.array(s) == 0, 0.0001, np.array(s) / max(sum(s), 1)) for s in (e, a))
    return float(np.sum((a - e) * np.log(a / e)))


def kl_reference(expected, actual, bins=10):
    q, edges = np.histogram(expected, bins=bins, density=True)
    p, _ = np.histogram(actual, bins=edges, density=True)
    p, q = np.maximum(p, 1e-8), np.maximum(q, 1e-8)
    p, q = p / p.sum(), q / q.sum()
    return float(np.sum(p * np.log(p / q)))


@pytest.mark.parametrize("seed", range(3))
def test_drift_tests_match_their_definitions(spark, seed):
    rng = random.Random(seed)
    a = [round(rng.gauss(0, 2), 1) for _ in range(300)]
    b = [round(rng.gauss(0.5, 3), 1) for _ in range(200)] + [50.0]
    base, serve = sample(spark, a + [None]), sample(spark, b + [None])
    assert drift.ks_two_sample(base, serve, "v").first()["statistic"] == pytest.approx(ks_reference(a, b))
    for q in (5, 10):
        assert drift.psi(base, serve, "v", q).first()[0] == pytest.approx(psi_reference(a, b, q))
    assert drift.kl_divergence(base, serve, "v").first()[0] == pytest.approx(kl_reference(a, b))


def test_drift_at_the_edges(spark):
    a, ties, none = sample(spark, range(50)), sample(spark, [1] * 40 + [2] * 10), sample(spark, [None])
    same = drift.ks_two_sample(a, a, "v").first()
    assert same["statistic"] == 0.0 and same["p_value"] == 1.0
    assert drift.psi(a, a, "v").first()[0] == 0.0
    far = drift.ks_two_sample(a, sample(spark, range(100, 150)), "v").first()
    assert far["statistic"] == 1.0 and far["p_value"] < 1e-10
    assert drift.psi(ties, ties, "v").first()[0] == 0.0  # duplicate quantile edges merge
    assert drift.psi(a, none, "v").first()[0] == 0.0 and drift.psi(none, a, "v").first()[0] == 0.0
    assert drift.psi(sample(spark, [3] * 9), a, "v").first()[0] == 0.0
    assert drift.ks_two_sample(a, none, "v").first()["p_value"] is None
    assert drift.kl_divergence(none, a, "v").first()[0] is None
    assert drift.kl_divergence(a, sample(spark, [1000]), "v").first()[0] is None
    assert drift.kl_divergence(sample(spark, [3] * 9), sample(spark, [3]), "v").first()[0] == pytest.approx(0.0)


def test_drift_report(spark):
    names = "runtimeMinutes double, numVotes double, startYear double, svd_1 double"
    base = spark.createDataFrame([(float(i), float(i), float(1950 + i % 60), i / 10) for i in range(300)], names)
    serve = spark.createDataFrame([(float(i), i + 200.0, float(2000 + i % 10), i / 10) for i in range(300)], names)
    rows = {(r["metric"], r["column"]): r["drifted"] for r in drift.drift_metrics(base, serve).collect()}
    assert rows == {("ks", "runtimeMinutes"): False, ("ks", "numVotes"): True, ("kl", "svd_1"): False, ("psi", "startYear"): True}
    import json

    document = json.loads(drift.passport(drift.drift_metrics(base, serve), serve).first()[0])
    assert document["retrain_recommended"] is True and document["serving_dataset_size"] == 300 and len(document["drift_report"]) == 4


def test_drift_of_all_columns_takes_the_same_jobs(spark):
    """One pass whatever the number of columns, each with the values that it has alone."""
    rng = random.Random(8)
    names = [f"svd_{i}" for i in range(6)]

    def side(shift):
        data = [tuple(None if rng.random() < 0.1 else round(rng.gauss(shift * i, 1 + i), 1) for i in range(6)) for _ in range(150)]
        return spark.createDataFrame([(*r[:5], None) for r in data], ", ".join(f"{c} double" for c in names))

    base, serve = side(0.0), side(0.3)

    def jobs(n):
        spark.sparkContext.setJobGroup(f"drift{n}", "")
        drift.drift_metrics(base, serve, tuple(names[:n]), "", tuple(names[:n])).collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"drift{n}"))

    try:
        assert jobs(1) == jobs(6)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for together, alone in ((drift.ks_tests, drift.ks_two_sample), (drift.kl_values, drift.kl_divergence), (drift.psi_values, drift.psi)):
        got = {r["column"]: tuple(r)[1:] for r in together(base, serve, names).collect()}
        for c in names:
            want = tuple(alone(base, serve, c).first())
            assert got[c] == want or got[c] == pytest.approx(want)
    found = {r["metric"] for r in drift.drift_metrics(base, serve, ("svd_5",), "", ("svd_5",)).collect()}
    assert not found  # a column without values has no test


# ---------------------------------------------------------------- splits


def test_folds_and_holdout_keep_class_balance(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = folds.stratified_folds(df, "y", "k").collect()
    assert len(got) == 1000 and len({r["k"] for r in got}) == 1000
    for y, n in ((0, 900), (1, 100)):
        sizes = Counter(r["fold"] for r in got if r["y"] == y)
        assert sum(sizes.values()) == n and max(sizes.values()) - min(sizes.values()) <= 1
    again = {r["k"]: r["fold"] for r in folds.stratified_folds(df.repartition(7), "y", "k").collect()}
    assert again == {r["k"]: r["fold"] for r in got}
    held = folds.stratified_holdout(df, "y", "k").where("is_holdout").collect()
    assert Counter(r["y"] for r in held) == {0: 135, 1: 15}


@pytest.mark.parametrize("interpolate", [False, True])
def test_quantiles_cut_crowded_buckets_again(spark, monkeypatch, interpolate):
    """With a limit of 40 rows per ordered bucket, ties of any size and special values included."""
    monkeypatch.setattr(ordering, "MOST_ROWS", 40)
    monkeypatch.setattr(ordering, "QUANTILE_BUCKETS", 4)
    draw = random.Random(11)
    a = [draw.gauss(0, 1) for _ in range(900)] + [0.25] * 700 + [-0.0, 0.0] + [None] * 30
    b = [float(draw.randint(0, 3)) for _ in range(1500)] + [float("inf")] * 100 + [None] * 32
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double").repartition(3)
    shares = [0.0, 0.01, 0.25, 0.5, 0.77, 0.9, 1.0]
    got = {(r["column"], r["fraction"]): r["value"] for r in ordering.quantiles(df, ["a", "b"], shares, interpolate).collect()}
    for c, values in (("a", a), ("b", b)):
        v = sorted(x for x in values if x is not None)
        for f in shares:
            at = (len(v) - 1) * f
            low, high = v[math.floor(at)], v[math.ceil(at)]
            expected = (low if low == high else low + (high - low) * (at - math.floor(at))) if interpolate else v[max(math.ceil(len(v) * f), 1) - 1]
            assert got[c, f] == pytest.approx(expected) or (math.isnan(got[c, f]) and high == math.inf), (c, f)


def test_ordered_buckets_stay_small(spark, monkeypatch):
    """The window that orders values never gets more rows than the limit, whatever the size of the input."""
    monkeypatch.setattr(ordering, "MOST_ROWS", 50)
    monkeypatch.setattr(ordering, "QUANTILE_BUCKETS", 4)
    seen = []
    plain = ordering._in_bucket
    rows = spark.range(4000).select(F.xxhash64("id").cast("double").alias("v"))
    monkeypatch.setattr(ordering, "_in_bucket", lambda c, cuts, k: seen.append((cuts, k)) or plain(c, cuts, k))
    value = ordering.quantiles(rows, ["v"], [0.5]).first()["value"]
    assert value == sorted(r[0] for r in rows.collect())[1999]
    for cuts, k in seen:  # one wanted rank: every range lies in the one before
        rows = rows.where(plain("v", cuts, k))
    assert rows.count() <= 50 and len(seen) >= 4


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    """A job with intermediate tables leaves nothing behind once they are cleared, and the next one can write again."""
    monkeypatch.setattr(session, "scratch_dir", lambda spark: f"{tmp_path}/own")
    edges = spark.createDataFrame([(i % 7, i % 5) for i in range(60)], "tconst int, nconst int")
    assert graph.same_role_weight(edges, "w").count() == 7
    assert os.listdir(f"{tmp_path}/own")
    session.clear_scratch(spark)
    assert not os.path.exists(f"{tmp_path}/own") or not os.listdir(f"{tmp_path}/own")
    assert graph.same_role_weight(edges, "w").count() == 7
