"""Median-absolute-deviation clamping, fitted once for all columns and reusable on other data."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footlight.operators.ordering import quantiles

# Makes the deviation comparable to a standard deviation of normal data (fixed value).
CONSISTENCY = 1.4826
PIPELINE_MULTIPLIER = 4.0

_SCHEMA = (
    "column string, n long, median double, mad double, lower double, upper double"
)


@dataclass(frozen=True)
class Bound:
    """Fitted limits of one column; ``lower`` and ``upper`` are None when the column must not be clamped."""

    column: str
    n: int
    median: float | None
    mad: float | None
    lower: float | None
    upper: float | None


def integer_columns(df: DataFrame, exclude: tuple[str, ...] = ("label",)) -> list[str]:
    whole = (T.IntegerType, T.LongType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, whole) and f.name not in exclude]


def _medians(df: DataFrame, columns: list[str], exact: bool) -> dict[str, tuple[int, float]]:
    """Column -> (non-null count, median); one row per column reaches the driver."""
    if exact:
        rows = quantiles(df, columns, [0.5]).collect()
        return {r["column"]: (r["n"], r["value"]) for r in rows}
    parts = [F.struct(F.count(c).alias("n"), F.percentile_approx(c, 0.5, 10_000).alias("m")) for c in columns]
    row = df.agg(*[p.alias(f"p{i}") for i, p in enumerate(parts)]).first()
    return {c: (row[i]["n"], float(row[i]["m"])) for i, c in enumerate(columns) if row[i]["m"] is not None}


def fit_bounds(
    df: DataFrame,
    columns: list[str] | None = None,
    multiplier: float = 3.0,
    constant: float = CONSISTENCY,
    exact: bool = True,
) -> list[Bound]:
    """Limits median +/- multiplier * constant * MAD of every column, two passes whatever the number of columns.

    A column with fewer than two values, or with MAD 0, gets no limits.  ``exact=False`` uses sketch medians.
    """
    columns = columns if columns is not None else integer_columns(df)
    if not columns:
        return []
    medians = _medians(df, columns, exact)
    usable = [c for c in columns if c in medians and medians[c][0] >= 2]
    distances = df.select(*[F.abs(F.col(c) - F.lit(medians[c][1])).alias(c) for c in usable])
    mads = _medians(distances, usable, exact) if usable else {}
    bounds = []
    for c in columns:
        n, median = medians.get(c, (0, None))
        mad = mads[c][1] if c in mads else None
        reach = multiplier * constant * mad if mad else None
        bounds.append(
            Bound(c, n, median, mad, median - reach if reach else None, median + reach if reach else None)
        )
    return bounds


def clamp(df: DataFrame, bounds: list[Bound]) -> DataFrame:
    """Pull values outside the limits onto them; nulls stay.  Whole-number columns use limits truncated toward zero."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for b in bounds:
        if b.lower is None or b.column not in types:
            continue
        kind = types[b.column]
        whole = isinstance(kind, T.IntegralType)
        low, high = (int(b.lower), int(b.upper)) if whole else (b.lower, b.upper)
        value = F.col(b.column)
        changed[b.column] = (
            F.when(value < b.lower, F.lit(low)).when(value > b.upper, F.lit(high)).otherwise(value).cast(kind)
        )
    return df.withColumns(changed) if changed else df


def clamp_report(df: DataFrame, bounds: list[Bound]) -> DataFrame:
    """One row per column: the fitted limits and how many values lie outside, counted in one pass."""
    rows = []
    for b in bounds:
        outside = (
            F.count_if(~F.col(b.column).between(b.lower, b.upper)) if b.lower is not None else F.lit(0).cast("long")
        )
        fields = {
            "column": F.lit(b.column),
            "n": F.lit(b.n).cast("long"),
            **{k: F.lit(v).cast("double") for k, v in asdict(b).items() if k not in ("column", "n")},
            "n_clamped": outside,
        }
        rows.append(F.struct(*[e.alias(k) for k, e in fields.items()]))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def bounds_table(spark: SparkSession, bounds: list[Bound]) -> DataFrame:
    """The limits as a table, to be saved with a model."""
    return spark.createDataFrame([tuple(asdict(b).values()) for b in bounds], _SCHEMA)


def load_bounds(table: DataFrame) -> list[Bound]:
    return [Bound(**r.asDict()) for r in table.collect()]
