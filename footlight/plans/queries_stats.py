"""Checked queries: association, evaluation, drift, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlight.operators import drift, evaluate, folds, stats
from footlight.plans.dirt import dirty, dirty_sql
from footlight.plans.registry import query, table

SPARSE = dirty_sql("sparse_parts")
ORDERS = "(select o_orderpriority, cast(o_orderstatus = 'F' as integer) as label from orders)"
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# Score of a document: a fixed function of its length, compared with its quality label.
SCORED = """(select l.doc_id, l.quality as label, d.lang, d.n_chars / (d.n_chars + 1000.0::double) as score
             from labels l join documents d on l.doc_id = d.doc_id)"""


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    label = (F.col("o_orderstatus") == "F").cast("int").alias("label")
    return table(spark, sf, "orders").select("o_orderpriority", label)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    joined = table(spark, sf, "labels").join(documents, "doc_id")
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))
    return joined.select("doc_id", F.col("quality").alias("label"), "lang", score.alias("score"))


def _clicks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf, "events")
    return events.where("event_type = 'click'"), events.where("event_type = 'view'")


_CONTINGENCY = f"""
cells as (select o_orderpriority, count(*) filter (where label = 0) as label_0, count(*) filter (where label = 1) as label_1
          from {ORDERS} group by o_orderpriority),
totals as (select sum(label_0)::double as t0, sum(label_1)::double as t1, count(*) as r from cells),
chi as (
  select sum(power(label_0 - (label_0 + label_1) * t0 / (t0 + t1), 2) / ((label_0 + label_1) * t0 / (t0 + t1))
           + power(label_1 - (label_0 + label_1) * t1 / (t0 + t1), 2) / ((label_0 + label_1) * t1 / (t0 + t1))) as statistic,
    max(t0 + t1) as n, max(r) - 1 as dof
  from cells, totals)
"""


@query(f"with {_CONTINGENCY} select * from cells")
def contingency(spark: SparkSession, sf: str) -> DataFrame:
    return stats.contingency(_orders(spark, sf), "o_orderpriority", "label")


# For four degrees of freedom the upper tail is exp(-x/2) * (1 + x/2).
@query(f"""
with {_CONTINGENCY}
select cast(n as bigint) as n, round(statistic, 6) as statistic, cast(dof as integer) as dof,
  round(exp(-statistic / 2) * (1 + statistic / 2), 6) as p_value from chi
""")
def chi_squared(spark: SparkSession, sf: str) -> DataFrame:
    test = stats.chi_squared(_orders(spark, sf), "o_orderpriority", "label").drop("cramers_v")
    return test.withColumns({c: F.round(c, 6) for c in ("statistic", "p_value")})


@query(f"with {_CONTINGENCY} select round(sqrt(statistic / n), 6) as cramers_v from chi")
def cramers_v(spark: SparkSession, sf: str) -> DataFrame:
    return stats.chi_squared(_orders(spark, sf), "o_orderpriority", "label").select(F.round("cramers_v", 6).alias("cramers_v"))


@query("""
select p_brand, count(*) as n, round(avg(case when p_size > 25 then 1.0 else 0.0 end), 6) as positive_rate
from part group by p_brand having count(*) >= 10 order by positive_rate, p_brand
""")
def group_positive_rate(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_brand", (F.col("p_size") > 25).cast("int").alias("label"))
    return stats.group_positive_rate(parts, "p_brand", "label").withColumn("positive_rate", F.round("positive_rate", 6))


@query(f"select count(label) as n, round(avg(label), 6) as positive_rate from {ORDERS}")
def overall_positive_rate(spark: SparkSession, sf: str) -> DataFrame:
    return stats.overall_rate(_orders(spark, sf), "label").withColumn("positive_rate", F.round("positive_rate", 6))


@query("""
select l_orderkey, l_linenumber, l_extendedprice,
  rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2.0::double as avg_rank
from lineitem
""")
def average_rank(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return stats.average_rank(lines, "l_extendedprice")


def _ranked(source: str, x: str, y: str) -> str:
    """Correlation of average ranks over the rows complete in both columns."""

    def rank(c: str) -> str:
        return f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0::double"

    return f"""select '{x}' as x, '{y}' as y, corr(rx, ry) as rho from (
      select {rank(x)} as rx, {rank(y)} as ry from {source} where {x} is not null and {y} is not null)"""


def _pairs_sql(source: str, columns: list[str]) -> str:
    pairs = [(x, y) for i, x in enumerate(columns) for y in columns[i + 1 :]]
    return " union all ".join(_ranked(source, x, y) for x, y in pairs)


@query(f"""
with pairs as ({_pairs_sql('lineitem', LINE_COLUMNS)})
select x, y, round(rho, 9) as rho from pairs union all select y, x, round(rho, 9) from pairs
union all select unnest({LINE_COLUMNS}), unnest({LINE_COLUMNS}), 1.0::double
""")
def spearman_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return stats.spearman_matrix(table(spark, sf, "lineitem"), LINE_COLUMNS).withColumn("rho", F.round("rho", 9))


@query(f"select x, y, round(rho, 9) as rho from ({_pairs_sql(SPARSE, ['p_partkey', 'p_size', 'p_retailprice'])})")
def spearman_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    parts = dirty(spark, sf, "sparse_parts")
    return stats.spearman_pairs(parts, ["p_partkey", "p_size", "p_retailprice"]).withColumn("rho", F.round("rho", 9))


# A perfect pair (with its sign turned), a strong one and two without correlation.
_LINKED = """(select l_quantity, -3 * l_quantity as falling, l_extendedprice, l_quantity * 1000 + l_extendedprice / 4 as charge from lineitem)"""
_LINKED_COLUMNS = ["l_quantity", "falling", "l_extendedprice", "charge"]


@query(f"""
select x, y, round(abs(rho), 9) as strength from ({_pairs_sql(_LINKED, _LINKED_COLUMNS)}) where abs(rho) >= 0.75
""")
def collinear_pairs(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_quantity",
        (-3 * F.col("l_quantity")).alias("falling"),
        "l_extendedprice",
        (F.col("l_quantity") * 1000 + F.col("l_extendedprice") / 4).alias("charge"),
    )
    return stats.collinear_pairs(lines, _LINKED_COLUMNS).withColumn("strength", F.round("strength", 9))


_COUNTS = f"""
counts as (select count(*) filter (where score >= 0.5 and label = 1) as tp, count(*) filter (where score >= 0.5 and label = 0) as fp,
  count(*) filter (where score < 0.5 and label = 0) as tn, count(*) filter (where score < 0.5 and label = 1) as fn from {SCORED})
"""


@query(f"with {_COUNTS} select * from counts")
def confusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion_counts(_scored(spark, sf), "label", "score")


@query(f"""
with {_COUNTS}
select tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn), 6) as accuracy,
  round(case when tp + fp > 0 then tp / (tp + fp) else 0 end, 6) as "precision",
  round(case when tp + fn > 0 then tp / (tp + fn) else 0 end, 6) as sensitivity,
  round(case when tn + fp > 0 then tn / (tn + fp) else 0 end, 6) as specificity
from counts
""")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = evaluate.classification_metrics(_scored(spark, sf), "label", "score")
    return metrics.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "sensitivity", "specificity")})


@query(f"""
with ranked as (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0::double as r from {SCORED}),
sums as (select sum(r) filter (where label = 1) as r1, count(*) filter (where label = 1)::double as p, count(*) filter (where label = 0)::double as n from ranked)
select round((r1 - p * (p + 1) / 2) / (p * n), 9) as auc from sums
""")
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.roc_auc(_scored(spark, sf), "label", "score").select(F.round("auc", 9).alias("auc"))


@query(f"""
with per_score as (select score, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg from {SCORED} group by score),
running as (select score, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as p, sum(neg) over () as n
  from per_score window w as (order by score desc rows unbounded preceding))
select round(score, 9) as threshold, round(fp / n, 9) as fpr, round(tp / p, 9) as tpr from running
union all select 'infinity'::double, 0.0::double, 0.0::double
""")
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = evaluate.roc_curve(_scored(spark, sf), "label", "score")
    return curve.withColumns({c: F.round(c, 9) for c in ("threshold", "fpr", "tpr")})


@query(f"""
select doc_id, label as true_label, round(score, 9) as predicted_prob, cast(score >= 0.5 as integer) as predicted_label, lang
from {SCORED} where cast(score >= 0.5 as integer) <> label
""")
def misclassified_report(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf)
    predictions = scored.select("doc_id", F.col("label").alias("true_label"), F.col("score").alias("predicted_prob"))
    report = evaluate.misclassified(predictions, table(spark, sf, "documents"), "doc_id", ["lang", "not_there"])
    return report.withColumn("predicted_prob", F.round("predicted_prob", 9))


@query(f"""
select count(*) as n_total, count(*) filter (where cast(score >= 0.5 as integer) <> label) as n_wrong,
  round(avg(case when cast(score >= 0.5 as integer) <> label then 1.0 else 0.0 end), 9) as wrong_rate from {SCORED}
""")
def misclassification_rate(spark: SparkSession, sf: str) -> DataFrame:
    rate = evaluate.misclassification_rate(_scored(spark, sf), "label", "score")
    return rate.withColumn("wrong_rate", F.round("wrong_rate", 9))


@query(f"""
select d.doc_id, case when s.score >= 0.5 then 'True' else 'False' end as prediction
from documents d left join {SCORED} s on d.doc_id = s.doc_id order by d.doc_id
""")
def ordered_predictions(spark: SparkSession, sf: str) -> DataFrame:
    predictions = _scored(spark, sf).select("doc_id", evaluate.predicted("score").alias("predicted_label"))
    keys = table(spark, sf, "documents").select("doc_id", F.col("doc_id").alias("position"))
    return evaluate.ordered_predictions(keys, predictions, "doc_id", ["position"]).orderBy("position").drop("position")


@query(f"select doc_id, score, 0 as absent, label from {SCORED}")
def align_features(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.align_features(_scored(spark, sf), ["score", "absent", "label"], extra=("doc_id",))


@query("""
with counts as (select value, count(*) as n from events group by value),
running as (select value, n, cast(sum(n) over (order by value rows unbounded preceding) as bigint) as cum_n, sum(n) over () as total from counts)
select value, n, cum_n, round(cum_n / total, 9) as share from running
""")
def cumulative_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return drift.cumulative_distribution(table(spark, sf, "events"), "value").withColumn("share", F.round("share", 9))


_KS = """
ks_values as (select value, count(*) filter (where event_type = 'click') as b, count(*) filter (where event_type = 'view') as s
           from events where event_type in ('click', 'view') group by value),
ks_running as (select sum(b) over w as cb, sum(s) over w as cs, sum(b) over () as n, sum(s) over () as m
            from ks_values window w as (order by value rows unbounded preceding)),
ks as (select max(abs(cb / n - cs / m)) as statistic, max(n) as n, max(m) as m from ks_running),
ks_test as (select cast(n as bigint) as n_base, cast(m as bigint) as n_serving, statistic,
  greatest(0, least(1, list_sum(list_transform(range(1, 101),
    lambda k: (case when k % 2 = 1 then 2.0 else -2.0 end)::double * exp(-2.0::double * k * k * (n * m / (n + m)) * statistic * statistic))))) as p_value
  from ks)
"""


@query(f"with {_KS} select n_base, n_serving, round(statistic, 9) as statistic, round(p_value, 9) as p_value from ks_test")
def ks_two_sample(spark: SparkSession, sf: str) -> DataFrame:
    test = drift.ks_two_sample(*_clicks(spark, sf), "value")
    return test.withColumns({c: F.round(c, 9) for c in ("statistic", "p_value")})


def _psi_sql(column: str, buckets: int) -> str:
    shares = ", ".join(str(i / buckets) for i in range(buckets + 1))
    return f"""
psi_edges as (select list_sort(list_distinct(quantile_cont({column}::double, [{shares}]))) as e from events where event_type = 'click'),
psi_bins as (select unnest(range(1, len(e))) as i, e from psi_edges),
psi_counts as (
  select i, (select count(*) from events where event_type = 'click' and {column} <= e[i + 1] and ({column} > e[i] or (i = 1 and {column} = e[1]))) as b,
         (select count(*) from events where event_type = 'view' and {column} <= e[i + 1] and ({column} > e[i] or (i = 1 and {column} = e[1]))) as s
  from psi_bins),
psi_shares as (select case when b = 0 then 0.0001 else b / sum(b) over () end as e, case when s = 0 then 0.0001 else s / sum(s) over () end as a from psi_counts),
psi as (select sum((a - e) * ln(a / e)) as psi from psi_shares)
"""


@query(f"with {_psi_sql('value', 10)} select round(psi, 9) as psi from psi")
def psi(spark: SparkSession, sf: str) -> DataFrame:
    return drift.psi(*_clicks(spark, sf), "value").select(F.round("psi", 9).alias("psi"))


_KL = """
kl_ends as (select min(value) as lo, max(value) as hi from events where event_type = 'click'),
kl_bins as (select i, lo + i * ((hi - lo) / 10) as a, case when i = 9 then hi else lo + (i + 1) * ((hi - lo) / 10) end as b, hi
            from kl_ends, (select unnest(range(10)) as i)),
kl_counts as (
  select i, b - a as width,
    (select count(*) from events where event_type = 'click' and value >= a and (value < b or (i = 9 and value = b))) as base,
    (select count(*) from events where event_type = 'view' and value >= a and (value < b or (i = 9 and value = b))) as serve
  from kl_bins),
kl_densities as (select greatest(serve / (width * sum(serve) over ()), 1e-8) as p, greatest(base / (width * sum(base) over ()), 1e-8) as q from kl_counts),
kl_shares as (select p / sum(p) over () as p, q / sum(q) over () as q from kl_densities),
kl as (select sum(p * ln(p / q)) as kl from kl_shares)
"""


@query(f"with {_KL} select round(kl, 9) as kl from kl")
def kl_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return drift.kl_divergence(*_clicks(spark, sf), "value").select(F.round("kl", 9).alias("kl"))


_METRICS = f"""
with {_KS}, {_KL}, {_psi_sql('user_id', 5)}, metrics as (
select 'ks' as metric, 'value' as "column", round(statistic, 9) as value, round(p_value, 9) as p_value, p_value < 0.05 as drifted from ks_test
union all select 'kl', 'value', round(kl, 9), null, kl > 0.5 from kl
union all select 'psi', 'user_id', round(psi, 9), null, psi > 0.2 from psi)
"""


@query(f"{_METRICS} select * from metrics")
def drift_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = drift.drift_metrics(*_clicks(spark, sf), ("value",), "user_id", ("value",))
    return metrics.withColumns({c: F.round(c, 9) for c in ("value", "p_value")})


@query()
def drift_passport(spark: SparkSession, sf: str) -> DataFrame:
    baseline, serving = _clicks(spark, sf)
    return drift.passport(drift.drift_metrics(baseline, serving, ("value",), "user_id", ("value",)), serving)


_PASSPORT = """drift_report array<struct<metric: string, column: string, value: double, p_value: double, drifted: boolean>>,
  retrain_recommended boolean, serving_dataset_size long"""


@query(f"""{_METRICS} select *, bool_or(drifted) over () as retrain_recommended,
  (select count(*) from events where event_type = 'view') as serving_dataset_size from metrics""")
def drift_passport_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """The passport document, parsed again: a row per metric with the flag and the size."""
    read = drift_passport(spark, sf).select(F.from_json("passport", _PASSPORT).alias("p")).select("p.*")
    rows = read.select(F.inline("drift_report"), "retrain_recommended", "serving_dataset_size")
    return rows.withColumns({c: F.round(c, 9) for c in ("value", "p_value")})


_SHUFFLED = """(select doc_id, quality, row_number() over (partition by quality order by md5(cast(doc_id as varchar) || '|42'), doc_id) as place,
  count(*) over (partition by quality) as size from labels)"""


@query(f"select doc_id, quality, cast((place - 1) % 3 as integer) as fold from {_SHUFFLED}")
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return folds.stratified_folds(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query(f"select doc_id, quality, place <= ceil(cast(0.15 as double) * size) as is_holdout from {_SHUFFLED}")
def stratified_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return folds.stratified_holdout(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 15")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(15)
