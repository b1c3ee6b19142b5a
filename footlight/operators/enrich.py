"""Joining external metadata onto titles, and features derived from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.functions.cells import guarded_ratio, product_or_zero
from footlight.functions.text import category_key
from footlight.operators.categorical import apply_vocabulary, collapse_rare, fit_vocabulary
from footlight.session import materialise

# (column, frequency below which a value counts as unknown): fixed values.
CATEGORIES = [
    ("tmdb_primary_genre", 0),
    ("tmdb_original_language", 0),
    ("tmdb_origin_country", 0),
    ("tmdb_production_company", 5),
]


def enrich(titles: DataFrame, enrichment: DataFrame, key: str = "tconst") -> DataFrame:
    """Left join; the enrichment holds one row per key, so no title is lost or repeated."""
    return titles.join(enrichment, key, "left")


def missing_keys(titles: DataFrame, cached: DataFrame | None, key: str = "tconst") -> DataFrame:
    """Non-null keys that the cached enrichment does not hold yet."""
    keys = titles.select(key).where(F.col(key).isNotNull()).distinct()
    return keys if cached is None else keys.join(cached.select(key), key, "left_anti")


def coverage(enrichment: DataFrame, success: str = "tmdb_success") -> DataFrame:
    """(n, n_success, success_rate)."""
    ok = F.coalesce(F.col(success), F.lit(False))
    return enrichment.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(ok).alias("n_success"),
        F.coalesce(F.avg(ok.cast("double")), F.lit(0.0)).alias("success_rate"),
    )


def coalesce_sources(df: DataFrame, target: str, other: str) -> DataFrame:
    """Fill ``target`` from ``other``, then drop ``other``."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(other))).drop(other)


def add_interactions(df: DataFrame) -> DataFrame:
    """Budget-to-revenue ratio and votes times popularity, where their inputs exist."""
    have = set(df.columns)
    new = {}
    if {"tmdb_budget", "tmdb_revenue"} <= have:
        new["budget_revenue_ratio"] = guarded_ratio(F.col("tmdb_budget"), F.col("tmdb_revenue"))
    if {"numVotes", "tmdb_popularity"} <= have:
        new["votes_x_popularity"] = product_or_zero(F.col("numVotes"), F.col("tmdb_popularity"))
    return df.withColumns(new) if new else df


def enrich_titles(
    titles: DataFrame, enrichment: DataFrame, vocabularies: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Enrichment phase: join, fill the runtime, normalise categories, add interactions.

    Returns the table and the vocabularies, fitted here unless given.
    """
    out = enrich(titles, enrichment)
    if {"runtimeMinutes", "tmdb_runtime"} <= set(out.columns):
        out = coalesce_sources(out, "runtimeMinutes", "tmdb_runtime")
    out = out.drop("tmdb_fetched_at")
    categories = [(c, k) for c, k in CATEGORIES if c in out.columns]
    # Written once: the vocabularies read single columns of it.
    out = materialise(out.withColumns({c: category_key(F.col(c)) for c, _ in categories}), "enriched")
    fitted = []
    for column, min_frequency in categories:
        if vocabularies is not None:
            out = apply_vocabulary(out, column, vocabularies)
        else:
            fitted.append(fit_vocabulary(out, column, min_frequency))
            out = collapse_rare(out, column, min_frequency) if min_frequency else out
    vocabularies = reduce(DataFrame.unionByName, fitted) if fitted else vocabularies
    return add_interactions(out), vocabularies
