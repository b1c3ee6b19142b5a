"""Run a registered query and its SQL twin and compare row count, columns, types and values."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _family(dtype: str) -> str:
    d = dtype.lower()
    if d in ("bigint", "long"):
        return "long"
    if d in ("integer", "int"):
        return "int"
    if d.startswith("varchar") or d == "string":
        return "string"
    return d


def _cell(value) -> str:
    if value is None:
        return "null"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def _rows(table) -> list[tuple]:
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns))


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    result = con.sql(sql)
    mine = {c: _family(t) for c, t in spark_df.dtypes}
    theirs = {c: _family(str(t)) for c, t in zip(result.columns, result.types)}
    found = []
    if mine != theirs:
        found.append(f"schema {sorted(mine.items() - theirs.items())} != {sorted(theirs.items() - mine.items())}")
    if set(mine) != set(theirs):
        return found
    a, b = _rows(spark_df.toArrow()), _rows(result.to_arrow_table())
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    else:
        wrong = [(x, y) for x, y in zip(a, b) if x != y]
        if wrong:
            found.append(f"{len(wrong)} rows differ, first {str(wrong[0])[:600]}")
    return found
