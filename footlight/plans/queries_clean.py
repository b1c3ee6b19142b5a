"""Checked queries: sources, cleaning, text and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlight.functions import cells, text
from footlight.operators import enrich, outliers
from footlight.plans.dirt import dirty, dirty_sql
from footlight.plans.registry import as_double, query, table
from footlight.session import scratch_path
from footlight.sources import sinks, tables

RAW, PAYLOAD = dirty_sql("raw_titles"), dirty_sql("part_payload")
SPARSE = dirty_sql("sparse_parts")


@query(f"""
select tid, case when trim(runtime_raw) in (',,', '', ' ') then null else runtime_raw end as runtime from {RAW}
""")
def null_standardise(spark: SparkSession, sf: str) -> DataFrame:
    raw = dirty(spark, sf, "raw_titles").select("tid", F.col("runtime_raw").alias("runtime"))
    return tables.standardise_nulls(raw, ["runtime"])


@query(f"""
select tid, label_raw from (select tid, label_raw from {RAW} union all select -1, 'label_raw')
where label_raw is null or label_raw <> 'label_raw'
""")
def filter_embedded_header(spark: SparkSession, sf: str) -> DataFrame:
    raw = dirty(spark, sf, "raw_titles").select("tid", "label_raw")
    header = spark.range(1).select(F.lit(-1).cast("long").alias("tid"), F.lit("label_raw").alias("label_raw"))
    return tables.drop_embedded_headers(raw.unionByName(header), "label_raw", "label_raw")


@query(f"""
select tid,
  case when start_raw is null and regexp_matches(end_raw, '^[0-9]{{4}}$') then end_raw else start_raw end as start_year,
  case when start_raw is null and regexp_matches(end_raw, '^[0-9]{{4}}$') then null else end_raw end as end_year
from {RAW}
""")
def repair_swap(spark: SparkSession, sf: str) -> DataFrame:
    start, end = cells.repaired_years(F.col("start_raw"), F.col("end_raw"))
    return dirty(spark, sf, "raw_titles").select("tid", start.alias("start_year"), end.alias("end_year"))


@query(f"""
select tid, case when lower(label_raw) in ('true', '1', '1.0', 'yes') then '1'
                 when lower(label_raw) in ('false', '0', '0.0', 'no') then '0' end as label
from {RAW}
""")
def map_boolean_label(spark: SparkSession, sf: str) -> DataFrame:
    return dirty(spark, sf, "raw_titles").select("tid", cells.label_word(F.col("label_raw")).alias("label"))


@query(f"""
select tid, try_cast(case when regexp_matches(x, '^[+-]?[0-9]+$') then x end as integer)::double as runtime
from (select tid, regexp_replace(runtime_raw, '\\.[0-9]+$', '') as x from {RAW})
""")
def int_cast(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(dirty(spark, sf, "raw_titles").select("tid", cells.to_int(F.col("runtime_raw")).alias("runtime")), "runtime")


@query(f"select tid, try_cast(runtime_raw as double) as runtime from {RAW}")
def float_cast(spark: SparkSession, sf: str) -> DataFrame:
    return dirty(spark, sf, "raw_titles").select("tid", cells.to_double(F.col("runtime_raw")).alias("runtime"))


@query(f"""
with cells as (
  select 'runtime_raw' as col, runtime_raw as v from {RAW} union all
  select 'start_raw', start_raw from {RAW} union all
  select 'end_raw', end_raw from {RAW} union all
  select 'label_raw', label_raw from {RAW}),
filled as (select col, trim(v) as v from cells where v is not null and trim(v) not in ('', ',,', chr(92)||'N')),
rates as (
  select col, count(*) as n_filled,
    avg(case when regexp_matches(v, '^[+-]?[0-9]+([.]0*)?$') then 1.0 else 0.0 end) as int_rate,
    avg(case when regexp_matches(v, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') then 1.0 else 0.0 end) as float_rate
  from filled group by col)
select col as "column", n_filled, round(int_rate, 9) as int_rate, round(float_rate, 9) as float_rate,
  case when int_rate >= 0.95 then 'int' when float_rate >= 0.95 then 'float' else 'text' end as kind
from rates
""")
def infer_column_classes(spark: SparkSession, sf: str) -> DataFrame:
    rates = tables.parse_rates(dirty(spark, sf, "raw_titles").drop("tid"))
    return rates.withColumns({c: F.round(c, 9) for c in ("int_rate", "float_rate")})


@query(f"""
select doc_id, lower(translate(
  replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(trim(text), '\\s{{2,}}', ' ', 'g'),
    'ß', 'ss'), 'æ', 'ae'), 'Æ', 'AE'), 'œ', 'oe'), 'Œ', 'OE'), 'þ', 'th'), 'Þ', 'Th'), 'ð', 'd'), 'Ð', 'D'), 'ł', 'l'), 'Ł', 'L'),
  '{text.ACCENTED}', '{text.PLAIN}')) as text
from documents
""")
def text_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.normalise_text(F.col("text")).alias("text"))


@query("""
with bare as (
  select doc_id, replace(regexp_replace(strip_accents(lower(text)), '[^\\x00-\\x7F]', '', 'g'), '-', '') as t from documents),
tokens as (
  select doc_id, list_filter(string_split_regex(regexp_replace(t, '[^A-Za-z0-9_]', ' ', 'g'), '\\s+'), lambda x: x <> '') as w
  from bare)
select doc_id, array_to_string(list_sort(list_distinct(w)), ' ') as fingerprint from tokens
""")
def fingerprint_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.fingerprint(F.col("text")).alias("fingerprint"))


@query("""
with words as (select unnest(string_split_regex(lower(text), '\\s+')) as w from documents),
counted as (select ' ' || w || ' ' as w, count(*) as n from words where w <> '' group by 1),
sized as (select w, n, unnest(range(2, least(4, length(w)) + 1)) as k from counted),
placed as (select w, n, k, unnest(range(1, length(w) - k + 2)) as i from sized)
select substr(w, i, k) as ngram, cast(sum(n) as bigint) as n from placed group by 1
""")
def char_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    return text.ngram_counts(table(spark, sf, "documents"), "text")


_MAD = """
with m as (select quantile_disc({c}, 0.5) as median, count({c}) as n from {t}),
d as (select quantile_disc(abs({c} - m.median), 0.5) as mad from {t}, m),
b as (select n, median, mad, median - cast({k} * 1.4826 as double) * mad as lower, median + cast({k} * 1.4826 as double) * mad as upper from m, d)
"""


@query(_MAD.format(c="value", t="events", k="4.0") + """
select 'value' as "column", n, round(median, 6) as median, round(mad, 6) as mad, round(lower, 6) as lower, round(upper, 6) as upper,
  (select count(*) from events, b where value not between lower and upper) as n_clamped
from b
""")
def mad_report(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    report = outliers.clamp_report(events, outliers.fit_bounds(events, ["value"], outliers.PIPELINE_MULTIPLIER))
    return report.withColumns({c: F.round(c, 6) for c in ("median", "mad", "lower", "upper")})


@query(_MAD.format(c="value", t="events", k="4.0") + """
select event_id, round(greatest(least(value, upper), lower), 6) as value from events, b
""")
def mad_clamp(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    bounds = outliers.fit_bounds(events, ["value"], outliers.PIPELINE_MULTIPLIER)
    return outliers.clamp(events.select("event_id", "value"), bounds).withColumn("value", F.round("value", 6))


def _clamp_all_sql(columns: list[str], source: str, k: str) -> str:
    limits, out = [], []
    for c in columns:
        limits.append(f"""
          m_{c} as (select quantile_disc({c}, 0.5) as med from {source}),
          d_{c} as (select med, quantile_disc(abs({c} - med), 0.5) as mad from {source}, m_{c} group by med),
          b_{c} as (select mad, med - cast({k} * 1.4826 as double) * mad as lo, med + cast({k} * 1.4826 as double) * mad as hi from d_{c})""")
        out.append(f"""
          case when b_{c}.mad = 0 then {c} when {c} < b_{c}.lo then cast(trunc(b_{c}.lo) as bigint)
               when {c} > b_{c}.hi then cast(trunc(b_{c}.hi) as bigint) else {c} end as {c}""")
    return "with " + ",".join(limits) + " select " + ",".join(out) + f" from {source}, " + ", ".join(f"b_{c}" for c in columns)


@query(
    "select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as integer) as l_linenumber from ("
    + _clamp_all_sql(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "lineitem", "1.0")
    + ")"
)
def mad_clamp_all(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    columns = outliers.integer_columns(lines)
    return outliers.clamp(lines.select(*columns), outliers.fit_bounds(lines, columns, 1.0))


@query("""
select p_partkey, lower(p_name) as p_name, lower(p_brand) as p_brand, lower(p_type) as p_type, p_size, p_retailprice from
(select cast(p_partkey as integer) as p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part)
""")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "part_csv")
    sinks.write_report(table(spark, sf, "part"), path)
    typed = tables.read_titles(spark, f"{path}/*.csv")
    names = [tables.camel_case(c) for c in table(spark, sf, "part").columns]
    return typed.select(*[F.col(n).alias(o) for n, o in zip(names, table(spark, sf, "part").columns)])


@query("""
select cast(event_id as varchar) as tconst, regexp_extract(props, '"k": *([0-9]+)', 1) as nconst from events
""")
def json_relation(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "relation_json")
    writer = F.get_json_object("props", "$.k").alias("writer")
    sinks.write_documents(table(spark, sf, "events").select(F.col("event_id").alias("movie"), writer), path)
    return tables.read_relation(spark, path, "writer", multiline=False)


@query(f"""
select p_partkey,
  case when payload is null then null else 0.0::double end as tmdb_popularity,
  cast(json_extract_string(payload, '$.budget') as double) as tmdb_budget,
  cast(json_extract_string(payload, '$.runtime') as double) as tmdb_runtime,
  json_extract_string(payload, '$.genres[0].name') as tmdb_primary_genre,
  json_extract_string(payload, '$.origin_country[0]') as tmdb_origin_country,
  json_extract_string(payload, '$.production_companies[0].name') as tmdb_production_company,
  payload is not null as tmdb_success
from {PAYLOAD}
""")
def payload_flatten(spark: SparkSession, sf: str) -> DataFrame:
    flat = tables.flatten_payload(dirty(spark, sf, "part_payload"))
    return as_double(flat, "tmdb_runtime").select(
        "p_partkey",
        "tmdb_popularity",
        "tmdb_budget",
        "tmdb_runtime",
        "tmdb_primary_genre",
        "tmdb_origin_country",
        "tmdb_production_company",
        "tmdb_success",
    )


@query("select d.doc_id, d.n_chars, l.quality::double as quality, l.toxic::double as toxic from documents d left join labels l on d.doc_id = l.doc_id")
def enrich_left_join(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "n_chars")
    return as_double(enrich.enrich(documents, table(spark, sf, "labels"), "doc_id"), "quality", "toxic")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def enrichment_missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.missing_keys(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("""
select count(*) as n, count(l.doc_id) as n_success, round(count(l.doc_id) / count(*), 9) as success_rate
from documents d left join labels l on d.doc_id = l.doc_id
""")
def enrichment_coverage(spark: SparkSession, sf: str) -> DataFrame:
    found = enrich.enrich(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")
    covered = enrich.coverage(found.withColumn("tmdb_success", F.col("quality").isNotNull()))
    return covered.withColumn("success_rate", F.round("success_rate", 9))


@query(f"""
select s.p_partkey, coalesce(s.p_size, cast(json_extract_string(p.payload, '$.runtime') as integer))::double as p_size
from {SPARSE} s left join {PAYLOAD} p on s.p_partkey = p.p_partkey
""")
def coalesce_sources(spark: SparkSession, sf: str) -> DataFrame:
    flat = tables.flatten_payload(dirty(spark, sf, "part_payload")).select("p_partkey", "tmdb_runtime")
    joined = enrich.enrich(dirty(spark, sf, "sparse_parts").select("p_partkey", "p_size"), flat, "p_partkey")
    return as_double(enrich.coalesce_sources(joined, "p_size", "tmdb_runtime"), "p_size")


@query("""
select l_orderkey, l_linenumber, round(case when l_discount > 0 then l_extendedprice / l_discount else 0.0 end, 6) as ratio
from lineitem
""")
def guarded_ratio(spark: SparkSession, sf: str) -> DataFrame:
    ratio = cells.guarded_ratio(F.col("l_extendedprice"), F.col("l_discount"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(ratio, 6).alias("ratio"))


@query(f"select p_partkey, round(coalesce(p_size, 0) * coalesce(p_retailprice, 0), 6) as product from {SPARSE}")
def interaction_product(spark: SparkSession, sf: str) -> DataFrame:
    product = cells.product_or_zero(F.col("p_size"), F.col("p_retailprice"))
    return dirty(spark, sf, "sparse_parts").select("p_partkey", F.round(product, 6).alias("product"))
