"""Distribution drift between a baseline and a serving sample."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footlight.operators.ordering import cut_points, quantiles, running_totals, running_values, with_buckets

# --- Fixed values -----------------------------------------------------------
KS_ALPHA = 0.05
KL_LIMIT = 0.5
PSI_LIMIT = 0.20
EMPTY_SHARE = 0.0001
EMPTY_DENSITY = 1e-8
CONTINUOUS = ("runtimeMinutes", "numVotes")
YEAR = "startYear"
# ----------------------------------------------------------------------------


def _both(baseline: DataFrame, serving: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of both sides with the columns as numbers c0.., and ``is_base``."""
    values = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]
    return baseline.select(*values, F.lit(1).alias("is_base")).unionByName(serving.select(*values, F.lit(0).alias("is_base")))


def _cells(rows: DataFrame, columns: list[str], bucket) -> DataFrame:
    """(column, _bucket, value, is_base) of every filled cell; ``bucket`` gives the expression of a column's bucket."""
    cells = [
        F.struct(F.lit(c).alias("column"), bucket(f"c{i}").alias("_bucket"), F.col(f"c{i}").alias("value"))
        for i, c in enumerate(columns)
    ]
    return rows.select("is_base", F.inline(F.array(*cells))).where(F.col("value").isNotNull())


_SIDES = {"base": F.sum, "serve": lambda c: F.sum(1 - F.col(c))}


def _sides() -> list[Column]:
    return [f("is_base").alias(k) for k, f in _SIDES.items()]


def _named(spark, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([(c,) for c in columns], "column string")


def cumulative_distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, n, cum_n, share): empirical distribution function over distinct values."""
    totals = running_values(df, column)
    share = F.col("cum_n").cast("double") / F.col("all_n")
    return totals.select(F.col(column).alias("value"), "n", "cum_n", share.alias("share"))


def ks_tests(baseline: DataFrame, serving: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_base, n_serving, statistic, p_value): largest gap between the two distribution functions of each column.

    All columns share one pass: the number of jobs does not depend on the number of columns.  The p-value is the asymptotic
    two-sided one; null when a side is empty.
    """
    both = _both(baseline, serving, columns)
    cells = _cells(with_buckets(both, cut_points(both, [f"c{i}" for i in range(len(columns))])), columns, lambda c: F.col(f"_b_{c}"))
    totals = running_totals(
        cells.groupBy("column", "_bucket", "value").agg(*_sides()),
        "value",
        list(_SIDES),
        ("column",),
        cells.groupBy("column", "_bucket").agg(*_sides()),
    )
    n, m = F.max("all_base"), F.max("all_serve")
    filled = (F.col("all_base") > 0) & (F.col("all_serve") > 0)
    gap = F.abs(F.col("cum_base").cast("double") / F.col("all_base") - F.col("cum_serve").cast("double") / F.col("all_serve"))
    largest = totals.groupBy("column").agg(n.alias("n_base"), m.alias("n_serving"), F.max(F.when(filled, gap)).alias("statistic"))
    # A column without values has no totals.
    every = _named(baseline.sparkSession, columns).join(largest, "column", "left")
    stat = every.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_base", "n_serving")})
    size = F.col("n_base").cast("double") * F.col("n_serving") / (F.col("n_base") + F.col("n_serving"))
    reach = F.sqrt(F.when(F.col("statistic").isNotNull(), size)) * F.col("statistic")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * reach * reach),
    )
    # Below 0.2 the alternating series has not converged and the true value is 1 to many digits.
    p = F.when(reach < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
    return stat.withColumn("p_value", F.when(F.col("statistic").isNotNull(), p))


def ks_two_sample(baseline: DataFrame, serving: DataFrame, column: str) -> DataFrame:
    """(n_base, n_serving, statistic, p_value) of one column, see :func:`ks_tests`."""
    return ks_tests(baseline, serving, [column]).drop("column")


def _above(value: float) -> float:
    return math.nextafter(value, math.inf)


def _binned(baseline: DataFrame, serving: DataFrame, edges: dict[str, list[float]], right_closed: bool) -> DataFrame:
    """(column, bin, width, base, serve, all_base, all_serve): rows per bin between a column's ``edges``, from one aggregation.

    Empty bins have their row too; values outside the edges are left out.
    """
    # Bins as half-open ranges: the outer edges belong to the first and last bin.
    cuts = {c: [e[0], *[_above(v) if right_closed or v == e[-1] else v for v in e[1:]]] for c, e in edges.items()}
    at = {f"c{i}": v for i, v in enumerate(cuts.values())}
    cells = _cells(
        _both(baseline, serving, list(edges)), list(edges), lambda c: _add((F.col(c) >= F.lit(v)).cast("int") for v in at[c])
    )
    counted = cells.groupBy("column", F.col("_bucket").alias("bin")).agg(*_sides())
    listed = [(c, i + 1, v - u) for c, e in edges.items() for i, (u, v) in enumerate(zip(e, e[1:]))]
    bins = baseline.sparkSession.createDataFrame(listed, "column string, bin int, width double")
    known = bins.join(counted, ["column", "bin"], "left").fillna(0, list(_SIDES))
    whole = Window.partitionBy("column")  # a row per bin
    return known.withColumns({f"all_{s}": F.sum(s).over(whole) for s in _SIDES})


def _add(terms) -> Column:
    return reduce(lambda a, b: a + b, terms)


def baseline_edges(baseline: DataFrame, columns: list[str], buckets: int) -> dict[str, list[float]]:
    """Distinct interpolated quantiles of the baseline: at most ``buckets`` + 1 numbers per column, of columns with two or more."""
    shares = [i / buckets for i in range(buckets + 1)]
    found: dict[str, set[float]] = {}
    for r in quantiles(baseline, columns, shares, interpolate=True).collect():
        found.setdefault(r["column"], set()).add(r["value"])
    return {c: sorted(v) for c, v in found.items() if len(v) > 1}


def psi_values(baseline: DataFrame, serving: DataFrame, columns: list[str], buckets: int = 10) -> DataFrame:
    """(column, psi): population stability index over right-closed bins between the baseline's quantiles, in one pass.

    Equal quantiles merge and the lowest value belongs to the first bin.  Serving values outside the baseline's
    range are not part of any share, an empty bin counts as 0.0001, and an empty side or a constant baseline gives 0.
    """
    named = _named(baseline.sparkSession, columns)
    edges = baseline_edges(baseline, columns, buckets)
    if not edges:
        return named.withColumn("psi", F.lit(0.0))

    def share(part: str) -> Column:
        return F.when(F.col(part) == 0, F.lit(EMPTY_SHARE)).otherwise(F.col(part).cast("double") / F.col(f"all_{part}"))

    counts = _binned(baseline, serving, edges, right_closed=True).withColumns({"e": share("base"), "a": share("serve")})
    filled = counts.where((F.col("all_base") > 0) & (F.col("all_serve") > 0))
    found = filled.groupBy("column").agg(F.sum((F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))).alias("psi"))
    return named.join(found, "column", "left").fillna(0.0, ["psi"])


def psi(baseline: DataFrame, serving: DataFrame, column: str, buckets: int = 10) -> DataFrame:
    """(psi) of one column, see :func:`psi_values`."""
    return psi_values(baseline, serving, [column], buckets).drop("column")


def uniform_edges(low: float, high: float, bins: int) -> list[float]:
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def kl_values(baseline: DataFrame, serving: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """(column, kl): divergence of the serving from the baseline histogram over equal-width bins of the baseline's range.

    Bins are left-closed, the last one also right-closed.  Densities are floored at 1e-8 and normalised; null when
    a side has no value in range.  All columns share one pass.
    """
    named = _named(baseline.sparkSession, columns)
    ends = baseline.agg(
        *[f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("low", F.min), ("high", F.max))]
    ).first()
    edges = {c: uniform_edges(ends[f"low{i}"], ends[f"high{i}"], bins) for i, c in enumerate(columns) if ends[f"low{i}"] is not None}
    if not edges:
        return named.withColumn("kl", F.lit(None).cast("double"))
    counts = _binned(baseline, serving, edges, right_closed=False)

    def density(part: str) -> Column:
        return F.greatest(F.col(part) / (F.col("width") * F.col(f"all_{part}")), F.lit(EMPTY_DENSITY))

    filled = counts.where((F.col("all_base") > 0) & (F.col("all_serve") > 0)).withColumns({"p": density("serve"), "q": density("base")})
    p, q, cross = F.sum("p"), F.sum("q"), F.sum(F.col("p") * F.ln(F.col("p") / F.col("q")))
    return named.join(filled.groupBy("column").agg((cross / p - F.ln(p / q)).alias("kl")), "column", "left")


def kl_divergence(baseline: DataFrame, serving: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(kl) of one column, see :func:`kl_values`."""
    return kl_values(baseline, serving, [column], bins).drop("column")


def drift_metrics(
    baseline: DataFrame,
    serving: DataFrame,
    continuous: tuple[str, ...] = CONTINUOUS,
    year: str = YEAR,
    components: tuple[str, ...] | None = None,
) -> DataFrame:
    """(metric, column, value, p_value, drifted): tidy rows of every test whose column exists on both sides.

    The number of jobs does not depend on the number of columns.
    ``components`` defaults to the columns named like 'svd'.
    """
    shared = [c for c in baseline.columns if c in serving.columns]
    components = tuple(c for c in shared if "svd" in c) if components is None else components
    parts = []

    def add(metric: str, found: DataFrame, value: str, drifted: Column) -> None:
        p = F.col("p_value") if "p_value" in found.columns else F.lit(None).cast("double")
        cells = [F.lit(metric).alias("metric"), "column", F.col(value).alias("value"), p.alias("p_value"), drifted.alias("drifted")]
        parts.append(found.where(F.col(value).isNotNull()).select(*cells))

    if tested := [c for c in continuous if c in shared]:
        add("ks", ks_tests(baseline, serving, tested), "statistic", F.col("p_value") < KS_ALPHA)
    if compared := [c for c in components if c in shared]:
        add("kl", kl_values(baseline, serving, compared), "kl", F.col("kl") > KL_LIMIT)
    if year in shared:
        add("psi", psi_values(baseline, serving, [year], 5), "psi", F.col("psi") > PSI_LIMIT)
    if not parts:
        raise ValueError("baseline and serving share no monitored column")
    return reduce(DataFrame.unionByName, parts)


def passport(metrics: DataFrame, serving: DataFrame) -> DataFrame:
    """(passport): one JSON document with all metrics, the retrain flag and the serving row count."""
    entry = F.struct("metric", "column", "value", "p_value", "drifted")
    report = metrics.agg(
        F.array_sort(F.collect_list(entry)).alias("drift_report"), F.bool_or("drifted").alias("retrain_recommended")
    )
    size = F.lit(serving.count()).alias("serving_dataset_size")
    return report.select(F.to_json(F.struct("drift_report", "retrain_recommended", size)).alias("passport"))
