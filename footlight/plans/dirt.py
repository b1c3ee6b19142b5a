"""Messy tables derived from the clean ones, row by row, with the same text for both engines.

The given tables hold no nulls and no malformed cells, so the cleaning and imputation queries read these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footlight.plans.registry import table

RAW_TITLES = {
    "tid": "event_id",
    "runtime_raw": (
        "case when event_id%17=0 then chr(92)||'N' when event_id%13=0 then ' ' when event_id%11=0 then ',,' "
        "when event_id%7=0 then cast(user_id as {S})||'.0' when event_id%101=0 then '1.2e6' "
        "else cast(user_id as {S}) end"
    ),
    "start_raw": "case when event_id%5=0 then cast(null as {S}) else cast(1900+user_id%120 as {S}) end",
    "end_raw": (
        "case when event_id%10=0 then cast(1950+user_id%70 as {S}) when event_id%3=0 then 'n/a' end"
    ),
    "label_raw": (
        "case event_id%7 when 0 then 'YES' when 1 then 'no' when 2 then 'True' when 3 then '0' "
        "when 4 then '1.0' when 5 then 'maybe' end"
    ),
}
PART_PAYLOAD = {
    "p_partkey": "p_partkey",
    "payload": (
        "case when p_partkey%11<>0 then "
        "'{{\"genres\":['||case when p_partkey%5=0 then '' else '{{\"name\":\"'||p_type||'\"}},{{\"name\":\"x\"}}' end||"
        "'],\"runtime\":'||case when p_partkey%7=0 then 'null' else cast(p_size as {S}) end||"
        "',\"budget\":'||cast(p_partkey%100 as {S})||',\"origin_country\":[\"'||p_brand||'\"]}}' end"
    ),
}
SPARSE_PARTS = {
    "p_partkey": "p_partkey",
    "p_type": "p_type",
    "p_size": "case when p_partkey%4=0 then null else p_size end",
    "p_retailprice": "case when p_partkey%5=0 then null else p_retailprice end",
    "p_brand": "case when p_partkey%6=0 then null else p_brand end",
}
SPARSE_CUSTOMERS = {
    "c_custkey": "c_custkey",
    "c_name": "case when c_custkey%6=0 then null else c_name end",
}
SOURCES = {
    "raw_titles": (RAW_TITLES, "events"),
    "part_payload": (PART_PAYLOAD, "part"),
    "sparse_parts": (SPARSE_PARTS, "part"),
    "sparse_customers": (SPARSE_CUSTOMERS, "customer"),
}


def dirty(spark: SparkSession, folder: str, name: str) -> DataFrame:
    columns, source = SOURCES[name]
    return table(spark, folder, source).selectExpr(*[f"{e.format(S='string')} as {c}" for c, e in columns.items()])


def dirty_sql(name: str) -> str:
    """The same table as a parenthesised SQL subquery."""
    columns, source = SOURCES[name]
    return "(select " + ", ".join(f"{e.format(S='varchar')} as {c}" for c, e in columns.items()) + f" from {source})"
