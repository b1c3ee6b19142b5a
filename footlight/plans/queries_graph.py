"""Checked queries: crew graph features, with order lines as edges (order = title, supplier and part = people)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlight.operators import graph
from footlight.plans.registry import as_double, query, table


def directors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("tconst"), F.col("l_suppkey").alias("nconst"))


def writers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("tconst"), F.col("l_partkey").alias("nconst"))


D = "(select l_orderkey as tconst, l_suppkey as nconst from lineitem)"
W = "(select l_orderkey as tconst, l_partkey as nconst from lineitem)"


def _degree_sql(edges: str, prefix: str) -> str:
    return f"""
    select e.tconst, avg(g.degree) as {prefix}_avg_centrality, count(e.nconst) as {prefix}_count
    from {edges} e left join (select nconst, count(*) as degree from {edges} group by nconst) g on e.nconst = g.nconst
    group by e.tconst"""


def _same_sql(edges: str, prefix: str) -> str:
    return f"""
    select tconst, max(weight) as {prefix}_{prefix}_max_collab_weight from (
      select a.tconst, count(*) over (partition by a.nconst, b.nconst) as weight
      from {edges} a join {edges} b on a.tconst = b.tconst and a.nconst < b.nconst)
    group by tconst"""


_CROSS = f"""
    select tconst, max(weight) as writer_director_max_collab_weight from (
      select w.tconst, count(*) over (partition by w.nconst, d.nconst) as weight
      from {W} w join {D} d on w.tconst = d.tconst)
    group by tconst"""


@query("select l_suppkey as nconst, count(*) as degree from lineitem group by l_suppkey")
def person_degree(spark: SparkSession, sf: str) -> DataFrame:
    return graph.person_degree(directors(spark, sf))


@query(f"select tconst, round(director_avg_centrality, 6) as director_avg_centrality, director_count from ({_degree_sql(D, 'director')})")
def degree_centrality(spark: SparkSession, sf: str) -> DataFrame:
    features = graph.degree_features(directors(spark, sf), "director")
    return features.withColumn("director_avg_centrality", F.round("director_avg_centrality", 6))


@query(f"""
select a.tconst, count(*) as n_pairs from {D} a join {D} b on a.tconst = b.tconst and a.nconst < b.nconst group by a.tconst
""")
def same_role_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return graph.same_role_pair_counts(directors(spark, sf))


@query(f"select w.tconst, count(*) as n_pairs from {W} w join {D} d on w.tconst = d.tconst group by w.tconst")
def cross_role_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return graph.cross_role_pair_counts(writers(spark, sf), directors(spark, sf))


@query(_same_sql(D, "director"))
def same_role_collab(spark: SparkSession, sf: str) -> DataFrame:
    return graph.same_role_weight(directors(spark, sf), "director")


@query(_CROSS)
def cross_role_collab(spark: SparkSession, sf: str) -> DataFrame:
    return graph.cross_role_weight(writers(spark, sf), directors(spark, sf), "writer", "director")


# Suppliers as titles: hundreds of lines each, all of them crowds; pairs are summed over distinct credits.
_BUYERS = "(select l_suppkey as tconst, l_orderkey as nconst, count(*) as m from lineitem group by all)"
_GOODS = "(select l_suppkey as tconst, l_partkey as nconst, count(*) as m from lineitem group by all)"


def _crowded(spark: SparkSession, sf: str, person: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("tconst"), F.col(person).alias("nconst"))


def _crowded_sql(a: str, b: str, on: str, name: str) -> str:
    return f"""
    with pairs as (select a.tconst, a.nconst as p, b.nconst as q, a.m * b.m as credits from {a} a join {b} b on {on}),
    weights as (select p, q, sum(credits) as weight from pairs group by p, q)
    select tconst, max(weight)::bigint as {name} from pairs join weights using (p, q) group by tconst"""


@query(_crowded_sql(_BUYERS, _BUYERS, "a.tconst = b.tconst and a.nconst < b.nconst", "buyer_buyer_max_collab_weight"))
def same_role_crowded(spark: SparkSession, sf: str) -> DataFrame:
    return graph.same_role_weight(_crowded(spark, sf, "l_orderkey"), "buyer")


@query(_crowded_sql(_BUYERS, _GOODS, "a.tconst = b.tconst", "buyer_goods_max_collab_weight"))
def cross_role_crowded(spark: SparkSession, sf: str) -> DataFrame:
    return graph.cross_role_weight(_crowded(spark, sf, "l_orderkey"), _crowded(spark, sf, "l_partkey"), "buyer", "goods")


@query(f"""
select o.o_orderkey as tconst, o.o_totalprice as total_price,
  round(dd.director_avg_centrality, 6) as director_avg_centrality, dd.director_count::double as director_count,
  round(wd.writer_avg_centrality, 6) as writer_avg_centrality, wd.writer_count::double as writer_count,
  ww.writer_writer_max_collab_weight::double as writer_writer_max_collab_weight,
  wx.writer_director_max_collab_weight::double as writer_director_max_collab_weight
from orders o
left join ({_degree_sql(D, 'director')}) dd on o.o_orderkey = dd.tconst
left join ({_degree_sql(W, 'writer')}) wd on o.o_orderkey = wd.tconst
left join ({_same_sql(W, 'writer')}) ww on o.o_orderkey = ww.tconst
left join ({_CROSS}) wx on o.o_orderkey = wx.tconst
""")
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    titles = table(spark, sf, "orders").select(F.col("o_orderkey").alias("tconst"), F.col("o_totalprice").alias("total_price"))
    matrix = graph.feature_matrix(titles, directors(spark, sf), writers(spark, sf))
    counts = ["director_count", "writer_count", "writer_writer_max_collab_weight", "writer_director_max_collab_weight"]
    matrix = as_double(matrix, *counts)
    return matrix.withColumns({c: F.round(c, 6) for c in ("director_avg_centrality", "writer_avg_centrality")})
