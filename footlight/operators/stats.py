"""Association between columns: rank correlation, contingency, chi-squared, per-group rates."""

from __future__ import annotations

import math
import sys
from collections import Counter
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footlight.operators.ordering import MAX_BUCKETS, average_rank_of, bucket_count, quantile_points, running_values, with_buckets
from footlight.operators.skew import lookup_join
from footlight.session import materialise

# --- Fixed values -----------------------------------------------------------
MIN_GROUP = 10
COLLINEAR = 0.75
# ----------------------------------------------------------------------------

MAX_DOUBLE = sys.float_info.max
# A column of at most this many values looks its ranks up in a broadcast table.
FEW_VALUES = 10_000
# Cells that a task orders or brings back to their rows: more cells get more tasks.
CELLS = 500_000
# The broadcast totals of buckets take at most this much, at 16 bytes a number; more columns get fewer buckets each.
OFFSET_BYTES = 32 << 20


def contingency(df: DataFrame, category: str, label: str) -> DataFrame:
    """(category, label_0, label_1): rows per category and binary label."""
    known = df.where(F.col(category).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(category).agg(
        F.count_if(F.col(label) == 0).alias("label_0"), F.count_if(F.col(label) == 1).alias("label_1")
    )


def _upper_tail(statistic: float, dof: int) -> float:
    """P(X > statistic) for chi-squared X: regularised upper incomplete gamma function Q(dof/2, statistic/2)."""
    a, x = dof / 2.0, statistic / 2.0
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - scale * total)
    b, c = x + 1 - a, 1e300
    d = h = 1.0 / b
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1.0 / (step * d + b)
        c = b + step / c
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return scale * h


@F.pandas_udf(T.DoubleType())
def _p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) or k < 1 else _upper_tail(s, int(k)) for s, k in zip(statistic, dof)])


def chi_squared(df: DataFrame, category: str, label: str) -> DataFrame:
    """(n, statistic, dof, p_value, cramers_v) of category against binary label, one row.

    With one degree of freedom every difference is reduced by up to one half (Yates).  Empty rows and columns of
    the table do not count; a table with a single row or column has statistic 0.
    """
    cells = contingency(df, category, label)
    totals = F.struct(F.count(F.lit(1)).alias("rows"), F.sum("label_0").alias("all_0"), F.sum("label_1").alias("all_1"))
    rows, all_0, all_1 = (F.col("_t")[c] for c in ("rows", "all_0", "all_1"))
    n = all_0 + all_1
    columns = (all_0 > 0).cast("int") + (all_1 > 0).cast("int")
    dof = ((rows - 1) * (columns - 1)).cast("int")
    size = F.col("label_0") + F.col("label_1")

    def term(observed: str, column_total):
        expected = size.cast("double") * column_total / n
        gap = F.abs(F.col(observed) - expected)
        gap = F.when(dof == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.when(column_total > 0, gap * gap / expected).otherwise(F.lit(0.0))

    per_cell = cells.withColumn("_t", cells.agg(totals.alias("_t")).scalar())
    summed = per_cell.groupBy(n.alias("n"), rows.alias("rows"), columns.alias("columns"), dof.alias("dof")).agg(
        F.sum(term("label_0", all_0) + term("label_1", all_1)).alias("statistic")
    )
    smaller = F.least(F.col("rows"), F.col("columns")) - 1
    return summed.select(
        F.col("n").cast("long").alias("n"),
        "statistic",
        "dof",
        F.when(F.col("dof") > 0, _p_value("statistic", "dof")).otherwise(F.lit(1.0)).alias("p_value"),
        F.when(smaller > 0, F.sqrt(F.col("statistic") / (F.col("n") * smaller))).otherwise(F.lit(0.0)).alias("cramers_v"),
    )


def group_positive_rate(df: DataFrame, category: str, label: str, min_group: int = MIN_GROUP) -> DataFrame:
    """(category, n, positive_rate) ascending by rate, groups of at least ``min_group`` labelled rows."""
    return (
        df.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.count(label).alias("n"), F.avg(F.col(label).cast("double")).alias("positive_rate"))
        .where(F.col("n") >= min_group)
        .orderBy("positive_rate", category)
    )


def overall_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count(label).alias("n"), F.avg(F.col(label).cast("double")).alias("positive_rate"))


def average_rank(df: DataFrame, column: str, output: str = "avg_rank") -> DataFrame:
    """Add the tie-averaged rank of ``column`` (null stays null)."""
    running = running_values(df, column)
    ranks = running.select(column, F.col("n").alias("_rows"), average_rank_of(running).alias(output))
    return lookup_join(df, materialise(ranks, "ranks"), [column], weight="_rows").drop("_rows")


def _split_cuts(df: DataFrame, columns: list[str], buckets: int) -> dict[str, list[float]]:
    """Cut points per column; a value that holds several of the approximate quantiles becomes a bucket of its own."""
    out = {}
    for c, found in quantile_points(df, columns, buckets).items():
        hot = {v for v, n in Counter(found).items() if n > 1}
        out[c] = sorted({*found, *[math.nextafter(v, math.inf) for v in hot if v < MAX_DOUBLE]})
    return out


def _rank_of(before, upto, ties):
    """Mean place of values that share a rank: ``upto`` of a part of the rows are not larger, ``ties`` are equal."""
    return before + upto - (ties - 1) / F.lit(2.0).cast("double")


def _few_value_ranks(rows: DataFrame, columns: list[str], sides: list[str]) -> DataFrame:
    """(column, value, rank0..) of columns with at most about ``FEW_VALUES`` values: counted, then ordered per column."""
    known = {f"n{k}": F.count(F.lit(1) if k == 0 else s) for k, s in enumerate(["", *sides])}
    cells = rows.select(*sides, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])))
    counted = cells.where(F.col("value").isNotNull()).groupBy("column", "value").agg(*[n.alias(k) for k, n in known.items()])
    upto = Window.partitionBy("column").orderBy("value")
    ranks = [_rank_of(F.lit(0), F.sum(n).over(upto), F.col(n)).alias(f"rank{k}") for k, n in enumerate(known)]
    return materialise(counted.select("column", "value", *ranks), "value_ranks")


def _cell_ranks(rows: DataFrame, columns: list[str], sides: list[str], parts: int | None = None) -> DataFrame:
    """(_row, column, rank0..) of every filled cell, from one exchange of the values of all columns.

    Cells are ordered inside buckets of their column.  A bucket with a single value needs no order: its cells get their rank
    from the bucket's totals and are not moved, so no task orders a hot value.
    """
    counts = range(len(sides) + 1)
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    buckets = min(max(bucket_count(rows.sparkSession), min(parts, MAX_BUCKETS)), OFFSET_BYTES // (32 * len(columns) * len(counts)))
    cuts = _split_cuts(rows, columns, max(2, buckets))
    alone = {c: [i + 1 for i, (u, v) in enumerate(zip(w, w[1:])) if v == math.nextafter(u, math.inf)] for c, w in cuts.items()}
    alone = {c: [*v, len(cuts[c]) + 1] if cuts[c] else [] for c, v in alone.items()}  # not-a-number is in the last one
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_b_{c}").alias("_bucket"),
            (F.col(f"_b_{c}").isin(alone[c]) if alone[c] else F.lit(False)).alias("_alone"),
            F.col(c).alias("value"),
        )
        for c in columns
    ]
    known = [F.lit(1).alias("k0"), *[F.col(s).isNotNull().cast("int").alias(f"k{k + 1}") for k, s in enumerate(sides)]]
    long = with_buckets(rows, cuts).select("_row", *known, F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    totals = long.groupBy("column", "_bucket").agg(*[F.sum(f"k{k}").alias(f"n{k}") for k in counts])
    before = Window.partitionBy("column").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumns({f"before{k}": F.coalesce(F.sum(f"n{k}").over(before), F.lit(0)) for k in counts})
    # At most OFFSET_BYTES: a row per column and bucket.
    placed = long.join(F.broadcast(materialise(offsets, "bucket_offsets")), ["column", "_bucket"])
    inside = Window.partitionBy("column", "_bucket").orderBy("value")
    ties = inside.rangeBetween(Window.currentRow, Window.currentRow)
    settled = placed.where("_alone").select(
        "_row", "column", *[_rank_of(F.col(f"before{k}"), F.col(f"n{k}"), F.col(f"n{k}")).alias(f"rank{k}") for k in counts]
    )
    ordered = placed.where(~F.col("_alone")).repartition(parts, "column", "_bucket").select(
        "_row",
        "column",
        *[_rank_of(F.col(f"before{k}"), F.sum(f"k{k}").over(inside), F.sum(f"k{k}").over(ties)).alias(f"rank{k}") for k in counts],
    )
    return settled.unionByName(ordered)


def _ranked_rows(rows: DataFrame, few: list[str], many: list[str], sides: list[str]) -> DataFrame:
    """A row per row with ``<column>_<k>``: the rank among the rows where side ``k`` is known (0: all); null where the cell is.

    Columns of few values look their ranks up.  The cells of the others are ranked together and brought back to their rows
    by one more exchange, whatever their number.
    """
    counts = range(len(sides) + 1)
    out = rows
    if many:
        rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        # Dealt by row before the aggregation, as its partial form would widen every cell to a whole row.
        parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1 + rows.count() * len(many) // CELLS)
        cells = _cell_ranks(rows, many, sides, parts).repartition(parts, "_row")
        wide = [F.max(F.when(F.col("column") == c, F.col(f"rank{k}"))).alias(f"{c}_{k}") for c in many for k in counts]
        out = cells.groupBy("_row").agg(*wide)
        out = rows.select("_row", *few).join(out, "_row", "left") if few else out
    if few:
        ranks = _few_value_ranks(rows, few, sides)
        for c in few:
            own = ranks.where(F.col("column") == c).select(F.col("value").alias(c), *[F.col(f"rank{k}").alias(f"{c}_{k}") for k in counts])
            out = out.join(F.broadcast(own), c, "left")  # about FEW_VALUES rows
    return out


def spearman_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, rho) for every unordered pair of columns, over the rows where both are known.

    In a pair, a value's rank counts the rows where the other column is known too.  So every value has one rank among all rows,
    which serves all columns without nulls, and one for each column with nulls; pairs are never listed row by row.
    """
    if len(columns) < 2:
        raise ValueError("a rank correlation needs at least two columns")
    names = [f"c{i}" for i in range(len(columns))]
    number = [F.col(c).cast("double") for c in columns]
    # -0.0 ranks as 0.0.
    rows = df.select(*[F.when(v == 0, F.lit(0.0)).otherwise(v).alias(n) for v, n in zip(number, names)])
    pairs = list(combinations(names, 2))
    both = {p: F.col(p[0]).isNotNull() & F.col(p[1]).isNotNull() for p in pairs}
    seen = rows.agg(
        F.count(F.lit(1)).alias("all"),
        *[F.count(c).alias(f"n_{c}") for c in names],
        *[F.approx_count_distinct(c).alias(f"d_{c}") for c in names],
        *[F.count_if(known).alias(f"{x}_{y}") for (x, y), known in both.items()],
    ).first()
    sides = [c for c in names if seen[f"n_{c}"] < seen["all"]]
    side = {c: sides.index(c) + 1 if c in sides else 0 for c in names}
    few = [c for c in names if seen[f"d_{c}"] <= FEW_VALUES]
    ranked = _ranked_rows(rows, few, [c for c in names if c not in few], sides)
    sums = []
    for i, (x, y) in enumerate(pairs):
        mean = (seen[f"{x}_{y}"] + 1) / 2.0
        known = F.col(f"{x}_0").isNotNull() & F.col(f"{y}_0").isNotNull()
        dx, dy = (F.when(known, F.col(f"{c}_{side[o]}") - F.lit(mean)) for c, o in ((x, y), (y, x)))
        xy, xx, yy = F.sum(dx * dy), F.sum(dx * dx), F.sum(dy * dy)
        # Null without variation or common rows.
        sums.append(F.when((xx > 0) & (yy > 0), xy / F.sqrt(xx * yy)).alias(f"r{i}"))
    label = dict(zip(names, columns))
    cells = [
        F.struct(F.lit(label[x]).alias("x"), F.lit(label[y]).alias("y"), F.col(f"r{i}").alias("rho")) for i, (x, y) in enumerate(pairs)
    ]
    return ranked.agg(*sums).select(F.inline(F.array(*cells)))


def spearman_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, rho): the full symmetric matrix in long form; the diagonal of a varying column is 1."""
    pairs = spearman_pairs(df, columns)
    spread = df.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns])
    diagonal = spread.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("x"),
                        F.lit(c).alias("y"),
                        F.when(F.col(c)["low"] < F.col(c)["high"], F.lit(1.0)).alias("rho"),
                    )
                    for c in columns
                ]
            )
        )
    )
    mirrored = pairs.select(F.col("y").alias("x"), F.col("x").alias("y"), "rho")
    return pairs.unionByName(mirrored).unionByName(diagonal)


def collinear_pairs(df: DataFrame, columns: list[str], threshold: float = COLLINEAR) -> DataFrame:
    """(x, y, strength): pairs with |rho| of at least ``threshold``, strongest first, perfect pairs included."""
    strength = F.abs("rho").alias("strength")
    return spearman_pairs(df, columns).select("x", "y", strength).where(F.col("strength") >= threshold).orderBy(F.desc("strength"), "x", "y")
