"""Order statistics without a single-task sort.

A window ordered over a whole column runs in one task.  Here values are first counted per distinct value,
then split into buckets at approximate quantiles; only one total per bucket is ordered globally and the
exact order inside each bucket is resolved in parallel.  The approximation decides how evenly the work is
split, never the result.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footlight.session import materialise

MAX_BUCKETS = 1000
QUANTILE_BUCKETS = 256
# A window that orders the values of one bucket gets at most this many rows; larger buckets are cut again.
MOST_ROWS = 1_000_000


def bucket_count(spark: SparkSession) -> int:
    return min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def quantile_points(df: DataFrame, columns: list[str], buckets: int) -> dict[str, list[float]]:
    """Approximate quantiles per column in order, repeated where a value holds several; finite ones only.  One job."""
    if buckets < 2:
        return {c: [] for c in columns}
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), shares, max(1000, 10 * buckets)).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return {c: [v + 0.0 for v in (row[i] or []) if not math.isnan(v) and not math.isinf(v)] for i, c in enumerate(columns)}


def cut_points(df: DataFrame, columns: list[str], buckets: int | None = None) -> dict[str, list[float]]:
    """Approximate quantile boundaries per column: at most ``MAX_BUCKETS`` numbers each, in one job."""
    points = quantile_points(df, columns, buckets or bucket_count(df.sparkSession))
    return {c: sorted(set(v)) for c, v in points.items()}


def with_buckets(df: DataFrame, cuts: dict[str, list[float]], prefix: str = "_b_") -> DataFrame:
    """Add an integer bucket per column; larger values never get a smaller bucket.

    The bucketizer tells -0.0 from 0.0, SQL does not: both are given the bucket of 0.0.
    """
    split = {c: v for c, v in cuts.items() if v}
    number = {c: F.col(c).cast("double") for c in split}
    out = df
    if split:
        out = Bucketizer(
            inputCols=[f"_d_{c}" for c in split],
            outputCols=[f"{prefix}{c}" for c in split],
            splitsArray=[[-math.inf, *v, math.inf] for v in split.values()],
            handleInvalid="keep",
        ).transform(df.withColumns({f"_d_{c}": F.when(v == 0, F.lit(0.0)).otherwise(v) for c, v in number.items()}))
        out = out.drop(*[f"_d_{c}" for c in split])
    return out.withColumns({f"{prefix}{c}": F.col(f"{prefix}{c}").cast("int") if v else F.lit(0) for c, v in cuts.items()})


def running_values(
    df: DataFrame, value: str, measures: dict[str, Column] | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """One row per distinct non-null value: (<by>, bucket, value, <m>, cum_<m>, all_<m>) for every measure ``m``.

    The default measure is the row count ``n``.  The counts per value are shuffled to be summed, and again to be ordered in
    their bucket; bucket totals come straight from the rows.
    """
    known = df.where(F.col(value).isNotNull())
    cuts = cut_points(known, [value])
    bucketed = with_buckets(known, cuts).withColumnRenamed(f"_b_{value}", "_bucket")
    measures = measures or {"n": F.count(F.lit(1))}
    aggregates = [e.alias(k) for k, e in measures.items()]
    return running_totals(
        bucketed.groupBy(*by, "_bucket", value).agg(*aggregates),
        value,
        list(measures),
        by,
        bucketed.groupBy(*by, "_bucket").agg(*aggregates),
    )


def running_totals(
    per_value: DataFrame, value: str, sums: list[str], by: tuple[str, ...] = (), totals: DataFrame | None = None
) -> DataFrame:
    """Add ``cum_<s>`` (running total in value order, inclusive) and ``all_<s>`` (grand total) to bucketed values.

    ``totals`` gives the sums per bucket when the caller has a cheaper way to them than the values.
    """
    keys = [*by, "_bucket"]
    if totals is None:
        totals = per_value.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
    # One row per bucket (at most MAX_BUCKETS + 1 for each ``by`` group): the only globally ordered step.
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(s).over(whole).alias(f"all_{s}") for s in sums],
    )
    inside = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = per_value.join(F.broadcast(offsets), keys)
    return joined.withColumns({f"cum_{s}": F.col(f"_before_{s}") + F.sum(s).over(inside) for s in sums}).drop(
        *[f"_before_{s}" for s in sums]
    )


def _bucket_of(counts: list[tuple[int, int]], rank: int) -> tuple[int, int]:
    """(bucket, rows before it) holding the value of ``rank``, from (bucket, rows) in bucket order."""
    before = 0
    for bucket, n in counts:
        if rank <= before + n:
            return bucket, before
        before += n
    raise ValueError(f"rank {rank} is beyond the {before} rows counted")


def _ends(n: int, fraction: float, interpolate: bool) -> tuple[list[tuple[str, int]], float]:
    """1-based ranks that decide a quantile of ``n`` values, and the weight of the higher one."""
    if not interpolate:
        return [("low", max(math.ceil(n * fraction), 1))], 0.0
    at = (n - 1) * fraction
    return [("low", math.floor(at) + 1), ("high", math.ceil(at) + 1)], at - math.floor(at)


def _in_bucket(column: str, cuts: list[float], bucket: int) -> Column:
    """Rows of a bucket as a range of the plain column, which a scan can use to skip data."""
    value = F.col(column)
    if not cuts:
        return value.isNotNull()
    if bucket > len(cuts):  # not-a-number, which sorts last
        return F.isnan(value)
    low = value >= F.lit(cuts[bucket - 1]) if bucket > 0 else F.lit(True)
    high = value < F.lit(cuts[bucket]) if bucket < len(cuts) else ~F.isnan(value)
    return value.isNotNull() & low & high


def quantiles(df: DataFrame, columns: list[str], fractions: list[float], interpolate: bool = False) -> DataFrame:
    """Exact quantiles of many columns at once: (column, n, fraction, value), |columns| x |fractions| rows.

    ``interpolate=False`` returns an element of the data (discrete quantile), ``True`` the linear interpolation.
    Nulls are ignored; a column without values has no rows.

    Rows are first counted per bucket, at most ``QUANTILE_BUCKETS`` + 1 counts per column, which tells the bucket of
    every wanted rank.  Only those buckets, a small share of the data, are then counted per value and ordered, after being
    cut again while they hold more than ``MOST_ROWS`` rows.
    """
    plain = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    cuts = cut_points(plain, columns, QUANTILE_BUCKETS)

    def cells(rows: DataFrame, kept: dict[str, Column]) -> DataFrame:
        made = [
            F.struct(F.lit(c).alias("column"), F.col(f"_b_{c}").alias("_bucket"), F.when(k, F.col(c)).alias("value"))
            for c, k in kept.items()
        ]
        return with_buckets(rows, cuts).select(F.inline(F.array(*made))).where(F.col("value").isNotNull())

    sizes = cells(plain, {c: F.lit(True) for c in columns}).groupBy("column", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    found = sorted(tuple(r) for r in sizes.collect())
    targets, kept, crowded = [], {}, {}
    for c in columns:
        counts = [(b, n) for name, b, n in found if name == c]
        total = sum(n for _, n in counts)
        for f in fractions if total else []:
            ends, share = _ends(total, f, interpolate)
            for end, rank in ends:
                bucket, before = _bucket_of(counts, rank)
                targets.append((c, bucket, before, total, float(f), end, rank, share))
                if dict(counts)[bucket] > MOST_ROWS:
                    crowded.setdefault((c, bucket, before), set()).add(rank - before)
                else:
                    kept.setdefault(c, {})[bucket] = _in_bucket(c, cuts[c], bucket)
    schema = "column string, _bucket int, before long, n long, fraction double, end string, rank long, share double"
    wanted = df.sparkSession.createDataFrame(targets, schema)
    # Buckets of too many rows are cut again and again; what is found there is one value per rank.
    solved = []
    for (c, bucket, before), ranks in crowded.items():
        part = plain.where(_in_bucket(c, cuts[c], bucket)).select(c)
        solved += [(c, bucket, before + r, v) for r, v in _values_at(part, c, sorted(ranks)).items()]
    known = df.sparkSession.createDataFrame(solved, "column string, _bucket int, rank long, value double")
    candidates = wanted.join(F.broadcast(known), ["column", "_bucket", "rank"]).select(*_FOUND)
    if kept:
        ranges = {c: reduce(or_, k.values()) for c, k in kept.items()}
        counted = cells(plain.where(reduce(or_, ranges.values())), ranges).groupBy("column", "_bucket", "value").agg(
            F.count(F.lit(1)).alias("m")
        )
        inside = Window.partitionBy("column", "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        ordered = counted.withColumn("cum", F.sum("m").over(inside))
        # ``wanted`` has at most two rows per column and fraction.
        found = ordered.join(F.broadcast(wanted), ["column", "_bucket"]).where(F.col("before") + F.col("cum") >= F.col("rank"))
        candidates = candidates.unionByName(found.select(*_FOUND))
    low = F.min(F.when(F.col("end") == "low", F.col("value")))
    high = F.min(F.when(F.col("end") == "high", F.col("value")))
    value = low + (high - low) * F.first("share") if interpolate else low
    return candidates.groupBy("column", "n", "fraction").agg(value.alias("value"))


_FOUND = ["column", "n", "fraction", "end", "share", "value"]


def _values_at(rows: DataFrame, column: str, ranks: list[int]) -> dict[int, float]:
    """Values of the given 1-based ranks of a column of known doubles.

    Beyond ``MOST_ROWS`` rows the column is cut at its quantiles, each of which becomes a bucket of its own, and only the
    buckets with a wanted rank are looked at again: a pass divides the rows by the number of buckets and shuffles a count
    per bucket.  The window at the end orders ``MOST_ROWS`` rows at most.
    """
    cuts = cut_points(rows, [column], QUANTILE_BUCKETS)[column]
    cuts = sorted({*cuts, *[math.nextafter(v, math.inf) for v in cuts]})
    bucketed = with_buckets(rows, {column: cuts}).withColumnRenamed(f"_b_{column}", "_bucket")
    counts = sorted(tuple(r) for r in bucketed.groupBy("_bucket").agg(F.count(F.lit(1))).collect())
    wanted: dict[tuple[int, int], list[int]] = {}
    for rank in ranks:
        wanted.setdefault(_bucket_of(counts, rank), []).append(rank)
    out = {}
    for (bucket, before), own in wanted.items():
        n = dict(counts)[bucket]
        alone = cuts[bucket - 1] if 0 < bucket < len(cuts) and cuts[bucket] == math.nextafter(cuts[bucket - 1], math.inf) else None
        if bucket > len(cuts) or not cuts:  # not-a-number, or infinities alone
            alone = math.nan if bucket > len(cuts) else alone
        part = rows.where(_in_bucket(column, cuts, bucket))
        if alone is not None:
            out |= dict.fromkeys(own, alone)
        elif n > MOST_ROWS and n < sum(m for _, m in counts):
            out |= {before + r: v for r, v in _values_at(part, column, [r - before for r in own]).items()}
        else:
            inside = Window.orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
            counted = part.groupBy(column).agg(F.count(F.lit(1)).alias("m")).withColumn("cum", F.sum("m").over(inside))
            ends = [F.min(F.when(F.col("cum") >= F.lit(r - before), F.col(column))).alias(f"r{i}") for i, r in enumerate(own)]
            out |= dict(zip(own, counted.agg(*ends).first()))
    return out


def average_rank_of(running: DataFrame) -> Column:
    """Rank of each distinct value, ties sharing the mean of the places they take, from running counts ``n``."""
    return running["cum_n"] - (running["n"] - 1) / F.lit(2.0).cast("double")


def sorted_positions(values: DataFrame, column: str, one_bucket: int = 10_000) -> DataFrame:
    """Zero-based position of every distinct value of ``column`` in sorted order: adds ``code``.

    Up to ``one_bucket`` values are numbered by one window.  More are cut into buckets at a hash sample of
    about 500 values, numbered inside each bucket and shifted by the bucket's offset.
    """
    values = materialise(values, "distinct_values")
    n = values.count()
    if n <= one_bucket:
        return values.withColumn("code", (F.row_number().over(Window.orderBy(column)) - 1).cast("int"))
    step = max(1, n // 500)
    sample = values.where(F.col(column).isNotNull() & (F.pmod(F.xxhash64(column), F.lit(step)) == 0))
    cuts = sorted(r[0] for r in sample.select(column).collect())
    below = F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(column))
    bucketed = values.withColumns({"_bucket": F.size(below), "n": F.lit(1)})
    numbered = running_totals(bucketed, column, ["n"])
    return numbered.withColumn("code", (F.col("cum_n") - 1).cast("int")).drop("_bucket", "n", "cum_n", "all_n")
