import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from footlight.sources import sinks, tables

HEADER = 'tconst,primary_title,originalTitle,start_year,endYear,runtimeMinutes,numVotes,label'.replace("start_year", "startYear")


@pytest.fixture
def shards(tmp_path):
    rows = [
        ["0", "tt1", '"The ""Big"", One"', "Große", "1990", "\\N", "90.0", "1000", "YES"],
        ["1", "tt2", "b", "c", "\\N", "1984", " ", "2e3", "no"],
        ["2", "tt3", "b", "c", ",,", "n/a", "100", "30", "maybe"],
    ]
    for name, part in (("train-1.csv", rows[:2]), ("train-2.csv", rows[2:])):
        lines = ["," + HEADER] + [",".join(f'"{c}"' if c == ",," else c for c in r) for r in part]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    return f"{tmp_path}/train-*.csv"


def test_raw_csv_cleans_structure(spark, shards):
    raw = tables.read_raw_csv(spark, shards)
    assert raw.columns[0] == tables.INDEX_COLUMN
    rows = {r["tconst"]: r for r in raw.collect()}
    assert set(rows) == {"tt1", "tt2", "tt3"}  # no embedded header rows
    assert rows["tt1"]["primaryTitle"] == 'The "Big", One'
    assert rows["tt1"]["endYear"] is None and rows["tt2"]["runtimeMinutes"] is None and rows["tt3"]["startYear"] is None


def test_titles_are_typed_and_repaired(spark, shards):
    classes = {"tconst": "text", "startYear": "int", "endYear": "int", "runtimeMinutes": "int", "numVotes": "int"}
    rows = {r["tconst"]: r for r in tables.read_titles(spark, shards, "titles", classes).collect()}
    assert rows["tt2"]["startYear"] == 1984 and rows["tt2"]["endYear"] is None
    assert rows["tt1"]["runtimeMinutes"] == 90 and rows["tt2"]["numVotes"] is None
    assert [rows[t]["label"] for t in ("tt1", "tt2", "tt3")] == [1, 0, None]
    assert "primaryTitle" not in rows["tt1"].asDict() and tables.INDEX_COLUMN not in rows["tt1"].asDict()


def test_classes_ignore_null_tokens(spark, tmp_path):
    lines = ["a,b,c,d"] + [f"{i},{i}.5,x{i},\\N" for i in range(40)] + ["\\N,1e3,y,\\N"]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    classes = tables.infer_classes(tables.typing_rows(spark, f"{tmp_path}/t.csv"))
    assert classes == {"a": "int", "b": "float", "c": "text", "d": "text"}
    typed = tables.read_titles(spark, f"{tmp_path}/t.csv")
    assert dict(typed.dtypes) == {"a": "int", "b": "double", "c": "string", "d": "string"}


def test_every_row_decides_the_types(spark, tmp_path):
    lines = ["a,b"] + [f"{i},{i}" for i in range(520)] + [f"x{i},{i}" for i in range(60)] + ["7,oops"]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    raw = tables.read_raw_csv(spark, f"{tmp_path}/t.csv")
    assert tables.infer_classes(tables.typing_rows(spark, f"{tmp_path}/t.csv")) == {"a": "text", "b": "int"}
    assert tables.infer_classes(tables.typing_rows(spark, f"{tmp_path}/t.csv", 500)) == {"a": "int", "b": "int"}
    assert dict(tables.read_titles(spark, f"{tmp_path}/t.csv").dtypes)["a"] == "string"
    lost = {r["column"]: r["n_lost"] for r in tables.lost_cells(raw, {"a": "int", "b": "int"}).collect()}
    assert lost == {"a": 60, "b": 1}
    assert tables.lost_cells(raw, {"a": "text"}).count() == 0


def test_snake_case_header_is_removed(spark, tmp_path):
    (tmp_path / "t.csv").write_text("my_id,my_label\n1,2\nmy_id,my_label\n3,\n")
    assert [tuple(r) for r in tables.read_raw_csv(spark, f"{tmp_path}/t.csv").collect()] == [("1", "2"), ("3", None)]


def test_missing_files_are_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        tables.read_raw_csv(spark, f"{tmp_path}/nothing-*.csv")


def test_unknown_mode_is_an_error(spark, shards):
    with pytest.raises(ValueError, match="unknown mode"):
        tables.read_titles(spark, shards, "other")


def test_names():
    assert [tables.camel_case(n) for n in ("start_year", "PrimaryTitle", '"tconst"', "", "RUN_TIME_minutes", "_")] == [
        "startYear", "primaryTitle", "tconst", "", "runTimeMinutes", "",
    ]
    assert tables.header_names(["a", "b"], 3) == ["syntheticIndex", "a", "b"]
    assert tables.header_names(["a", "b"], 5) == ["syntheticIndex", "a", "b", "extraCol3", "extraCol4"]
    assert tables.header_names(["", "a"], 2) == ["syntheticIndex", "a"]


EDGES = [("tt1", "nm1"), ("tt1", "nm1"), ("tt2", None)]


@pytest.mark.parametrize("form", ["records", "columns", "lines"])
def test_relations(spark, tmp_path, form):
    records = [{"movie": m, "writer": w} for m, w in EDGES]
    content = {
        "records": json.dumps(records, indent=1),
        "columns": json.dumps({"movie": {str(i): r["movie"] for i, r in enumerate(records)}, "writer": {str(i): r["writer"] for i, r in enumerate(records)}}),
        "lines": "\n".join(map(json.dumps, records)),
    }[form]
    (tmp_path / "r.json").write_text(content)
    got = tables.read_relation(spark, f"{tmp_path}/r.json", "writer", multiline=form != "lines")
    assert got.columns == ["tconst", "nconst"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(EDGES, key=str)


def test_one_array_is_many_tasks(spark, tmp_path):
    """A single file with an array of a million objects is read in pieces, edges mended; what cannot be cut is read whole."""
    n = 1_000_000
    with open(tmp_path / "large.json", "w") as f:
        f.write("[" + ", \n".join(f'{{"movie": "tt{i}", "writer": {f"""\"nm{i % 7}\"""" if i % 9 else "null"}}}' for i in range(n)) + "]\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        got = tables.read_relation(spark, f"{tmp_path}/large.json")
        assert got.rdd.getNumPartitions() > 10
        row = got.agg(F.count("tconst"), F.countDistinct("tconst"), F.count("nconst"), F.max(F.length("nconst"))).first()
        assert tuple(row) == (n, n, n - (n + 8) // 9, 3)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("movie", ["a } b", "x\"}, {\"movie\": \"y", "[", "tt\\1", "é,"])
def test_arrays_with_odd_strings(spark, tmp_path, movie):
    records = [{"movie": movie, "writer": "w"}, {"writer": None, "movie": "b", "more": 3}, {"movie": None}]
    (tmp_path / "r.json").write_text(json.dumps(records, ensure_ascii=False))
    got = tables.read_relation(spark, f"{tmp_path}/r.json")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(movie, "w"), ("b", None), (None, None)], key=str)
    (tmp_path / "e.json").write_text(" [ ]")
    assert tables.read_relation(spark, f"{tmp_path}/e.json").count() == 0


def test_payload_flattening(spark):
    full = {"popularity": 1.5, "budget": 10, "runtime": 90, "genres": [{"name": "Drama"}, {"name": "X"}], "origin_country": ["US", "FR"], "original_language": "en"}
    empty = {"genres": [], "production_companies": [], "origin_country": [], "runtime": None}
    rows = spark.createDataFrame([("a", json.dumps(full)), ("b", json.dumps(empty)), ("c", None)], "tconst string, payload string")
    got = {r["tconst"]: r.asDict() for r in tables.flatten_payload(rows).collect()}
    assert got["a"]["tmdb_primary_genre"] == "Drama" and got["a"]["tmdb_origin_country"] == "US"
    assert got["a"]["tmdb_revenue"] == 0.0 and got["a"]["tmdb_runtime"] == 90 and got["a"]["tmdb_production_company"] is None
    assert got["b"]["tmdb_primary_genre"] is None and got["b"]["tmdb_popularity"] == 0.0 and got["b"]["tmdb_runtime"] is None
    assert got["c"].pop("tmdb_success") is False and got["c"].pop("tconst") == "c" and set(got["c"].values()) == {None}


def test_optional_table(spark, tmp_path):
    assert tables.optional_parquet(spark, f"{tmp_path}/none") is None
    sinks.write_table(spark.range(3), f"{tmp_path}/some")
    sinks.write_table(spark.range(2), f"{tmp_path}/some")  # replaces
    assert tables.optional_parquet(spark, f"{tmp_path}/some").count() == 2


def read_parts(folder):
    names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    return "".join(open(f"{folder}/{n}").read() for n in names)


def test_lines_keep_order_over_parts(spark, tmp_path):
    rows = spark.range(1000).select("id", F.col("id").cast("string").alias("prediction")).repartition(7)
    sinks.write_lines(rows, f"{tmp_path}/lines", order=["id"])
    assert read_parts(f"{tmp_path}/lines").split() == [str(i) for i in range(1000)]


def test_reports_and_documents(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a,b")], "x int, y string").coalesce(1)
    sinks.write_report(rows, f"{tmp_path}/csv")
    assert read_parts(f"{tmp_path}/csv") == 'x,y\n1,"a,b"\n'
    sinks.write_documents(rows, f"{tmp_path}/json")
    assert [r.asDict() for r in sinks.read_documents(spark, f"{tmp_path}/json").collect()] == [{"x": 1, "y": "a,b"}]
