"""Checked queries: vocabularies, category codes, null profiles and simple imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlight.operators import categorical, impute
from footlight.plans.dirt import dirty, dirty_sql
from footlight.plans.registry import as_double, query, table

RARE = 80  # rows below which a brand is rare
SPARSE, CUSTOMERS = dirty_sql("sparse_parts"), dirty_sql("sparse_customers")

_COUNTS = "counts as (select p_brand, count(*) as n from part group by p_brand)"
_VOCABULARY = f"""
{_COUNTS},
kept as (select case when n < {RARE} then 'unknown' else p_brand end as value, cast(sum(n) as bigint) as n from counts group by 1),
coded as (select value, n, cast(row_number() over (order by value) - 1 as integer) as code from kept),
vocabulary as (
  select 'p_brand' as "column", value, code, n from coded
  union all select 'p_brand', 'unknown', (select cast(count(*) as integer) from coded), 0
  where not exists (select 1 from coded where value = 'unknown'))
"""


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return categorical.fit_vocabulary(table(spark, sf, "part"), "p_brand", RARE)


@query(f"with {_VOCABULARY} select * from vocabulary")
def vocabulary_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _vocabulary(spark, sf)


@query(f"""
with {_VOCABULARY}
select p_partkey, case when p_brand in (select value from vocabulary) then p_brand else 'unknown' end as p_brand from part
""")
def vocabulary_apply(spark: SparkSession, sf: str) -> DataFrame:
    return categorical.apply_vocabulary(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", _vocabulary(spark, sf))


@query(f"with {_VOCABULARY} select p_brand as value, n from counts where p_brand not in (select value from vocabulary)")
def vocabulary_unseen(spark: SparkSession, sf: str) -> DataFrame:
    return categorical.unseen_values(table(spark, sf, "part"), "p_brand", _vocabulary(spark, sf))


@query(f"""
with {_COUNTS}
select p.p_partkey, case when c.n < {RARE} then 'unknown' else p.p_brand end as p_brand from part p join counts c on p.p_brand = c.p_brand
""")
def rare_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return categorical.collapse_rare(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", RARE)


@query(f"""
with keyed as (
  select p_partkey, coalesce(array_to_string(list_sort(list_distinct(list_filter(
    string_split_regex(regexp_replace(lower(p_brand), '[^a-z0-9_]', ' ', 'g'), ' +'), lambda x: x <> ''))), ' '), 'unknown') as p_brand
  from {SPARSE}),
sized as (select p_partkey, p_brand, count(*) over (partition by p_brand) as n from keyed)
select p_partkey, case when n < {RARE} then 'unknown' else p_brand end as p_brand from sized
""")
def normalize_categorical(spark: SparkSession, sf: str) -> DataFrame:
    parts = dirty(spark, sf, "sparse_parts").select("p_partkey", "p_brand")
    return categorical.normalise_category(parts, "p_brand", min_frequency=RARE)[0]


@query(f"""
with codes as (select p_type, cast(row_number() over (order by p_type) - 1 as integer) as code from (select distinct p_type from part))
select p.p_partkey, p.p_brand, coalesce(b.code, -1) as brand_code, t.code as type_code
from {SPARSE} p join codes t on p.p_type = t.p_type
left join (select p_brand, cast(row_number() over (order by p_brand) - 1 as integer) as code
           from (select distinct p_brand from {SPARSE} where p_brand is not null)) b on p.p_brand = b.p_brand
""")
def category_codes(spark: SparkSession, sf: str) -> DataFrame:
    parts = dirty(spark, sf, "sparse_parts").select("p_partkey", "p_brand", "p_type")
    coded = categorical.category_codes(parts, "p_brand", "brand_code")
    return categorical.category_codes(coded, "p_type", "type_code").drop("p_type")


@query(f"""
with {_VOCABULARY}
select p.p_partkey, coalesce(p.p_brand, 'Unknown') as p_brand, v.code::double as p_brand_code
from {SPARSE} p left join vocabulary v on p.p_brand = v.value
""")
def category_map_apply(spark: SparkSession, sf: str) -> DataFrame:
    parts = dirty(spark, sf, "sparse_parts").select("p_partkey", "p_brand")
    return as_double(categorical.apply_category_map(parts, ["p_brand"], _vocabulary(spark, sf)), "p_brand_code")


@query(f"""
select c as "column", n, n_known, case when n = n_known then 'dense' when n_known = 0 then 'hollow' else 'partial' end as state from (
  select 'p_partkey' as c, count(*) as n, count(p_partkey) as n_known from {SPARSE} union all
  select 'p_type', count(*), count(p_type) from {SPARSE} union all
  select 'p_size', count(*), count(p_size) from {SPARSE} union all
  select 'p_retailprice', count(*), count(p_retailprice) from {SPARSE} union all
  select 'p_brand', count(*), count(p_brand) from {SPARSE})
""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return impute.null_profile(dirty(spark, sf, "sparse_parts"))


@query(f"""
select p_partkey,
  coalesce(p_brand, (select p_brand from {SPARSE} where p_brand is not null group by p_brand order by count(*) desc, p_brand limit 1)) as p_brand,
  round(coalesce(p_retailprice, (select median(p_retailprice) from {SPARSE})), 6) as p_retailprice
from {SPARSE}
""")
def impute_fallback(spark: SparkSession, sf: str) -> DataFrame:
    parts = dirty(spark, sf, "sparse_parts").select("p_partkey", "p_brand", "p_retailprice")
    filled = impute.fill_fallback(impute.fill_fallback(parts, "p_brand"), "p_retailprice")
    return filled.withColumn("p_retailprice", F.round("p_retailprice", 6))


@query(f"""
select c_custkey, case when c_name is null and (select count(distinct c_name) from {CUSTOMERS}) > 1000 then 'Unknown' else c_name end as c_name
from {CUSTOMERS}
""")
def impute_high_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return impute.fill_high_cardinality(dirty(spark, sf, "sparse_customers"), "c_name")


@query("""
with s as (select avg(l_quantity) as mq, stddev_pop(l_quantity) as sq, avg(l_extendedprice) as mp, stddev_pop(l_extendedprice) as sp from lineitem)
select l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) as l_quantity, round((l_extendedprice - mp) / sp, 6) as l_extendedprice
from lineitem, s
""")
def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    scaled = impute.standard_scale(lines, ["l_quantity", "l_extendedprice"])
    return scaled.withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_extendedprice")})
