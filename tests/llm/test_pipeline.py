"""The pipeline, stage by stage, against plain versions."""

from collections import Counter

import brute
import corpus_pipeline
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from test_text_operators import frame, sample_texts

from footlight.llm import mixing, pieces
from footlight.session import materialise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def rows(extra=()):
    out = [(7 * i + 3, t, "en" if i % 4 else None, ["a", "b", None][i % 3], None if t is None else len(t)) for i, t in enumerate(sample_texts(9))]
    return out + list(extra)


def run(spark, name, docs, kept=SCHEMA):
    out = STAGES[name](spark, docs, "")
    if name != "pieces":
        assert set(out.columns) == set(docs.columns)
    return materialise(out, "test")


def test_language_stage(spark):
    got = run(spark, "language", frame(spark, rows([(901, "12 34", "en", "a", 5)]), SCHEMA)).collect()
    expected = [r for r in rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter(tuple(x)[:5] for x in got) == Counter(expected)
    blank = frame(spark, [(1, "no languages taught", None, "a", 5), (2, "1", None, "a", 1)], SCHEMA)
    assert [x["doc_id"] for x in run(spark, "language", blank).collect()] == [1]


def test_language_stage_passes_all_columns_on(spark):
    names = ["score", "languages", "shares", "lang_pred", "_whole", "_rest", "_text"]
    docs = frame(spark, [(1, "some text", "en", "a", 9), (2, "7", "en", "a", 1)], SCHEMA).withColumns({c: F.lit(c) for c in names})
    out = STAGES["language"](spark, docs, "")
    assert out.columns == docs.columns
    got = [x.asDict() for x in out.collect()]
    assert [x["doc_id"] for x in got] == [1] and all(got[0][c] == c for c in names) and got[0]["text"] == "some text"


def test_language_stage_decides(spark):
    """Random letters and a language that no document teaches go; taught ones stay, short, mixed or long."""
    taught = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    strange = ["zxqv wkjh qqqq zzzx vvkq", "x", "qzxwvjjkqx", "\u042d\u0442\u043e \u0441\u043e\u0432\u0441\u0435\u043c \u0434\u0440\u0443\u0433\u043e\u0439 \u044f\u0437\u044b\u043a"]
    extra = spark.createDataFrame([(10**6 + i, t, None, "a", len(t)) for i, t in enumerate(strange)], SCHEMA)
    mixed = spark.createDataFrame([(2 * 10**6, "the of and to that der die und nicht", None, "a", 9), (2 * 10**6 + 1, "the and", None, "a", 7)], SCHEMA)
    got = {x["doc_id"] for x in run(spark, "language", taught.unionByName(extra).unionByName(mixed)).select("doc_id").collect()}
    assert got == {r[0] for r in taught.select("doc_id").collect()} | {2 * 10**6, 2 * 10**6 + 1}


def test_near_duplicate_stage(spark):
    """Rows are judged each, whatever their ids: the smallest id of a group stays, null last."""
    extra = [(3, None, None, "a", 0), (4000, "repeated row " * 9, "en", "a", 1), (4000, "repeated row " * 9, "en", "a", 1), (None, "no id " * 9, "en", "a", 1)]
    extra += [(None, "no id " * 9, "en", "b", 1), (1, "text b " * 9, "en", "a", 1), (1, "text a " * 9, "en", "a", 1), (2, "text b " * 9, "en", "a", 1)]
    given = rows(extra)
    got = run(spark, "near_duplicates", frame(spark, given, SCHEMA)).collect()
    parts = brute.near_duplicates({i: r[1] for i, r in enumerate(given)}, 5, (80, 100))
    groups = {}
    for i, (_, c) in parts.items():
        groups.setdefault(c, []).append(i)
    kept = [min(g, key=lambda i: (given[i][0] is None, given[i][0] or 0)) for g in groups.values()]
    assert Counter((x["doc_id"], x["text"]) for x in got) == Counter((given[i][0], given[i][1]) for i in kept)
    assert {(x["doc_id"], x["text"]) for x in got} >= {(1, "text b " * 9), (1, "text a " * 9), (None, "no id " * 9)}


def test_repeat_stage(spark):
    got = {x["doc_id"]: x for x in run(spark, "repeats", frame(spark, rows(), SCHEMA)).collect()}
    seen = 0
    for r, (n, removed, kept) in zip(rows(), brute.without_repeats([r[1] for r in rows()], 35)):
        if n and removed == n:
            assert r[0] not in got
            continue
        x = got[r[0]]
        assert brute.words(x["text"]) == kept and (x["lang"], x["source"]) == r[2:4]
        assert x["n_chars"] == (None if r[1] is None else len(x["text"]))
        seen += removed > 0
    assert seen >= 6


def test_mix_stage(spark):
    docs = frame(spark, rows(), SCHEMA)
    got = Counter(x["doc_id"] for x in run(spark, "mix", docs).collect())
    expected = Counter()
    for x in mixing.mix(docs, corpus_pipeline.SCHEDULES).collect():
        expected[x["doc_id"]] += sum(2 * p["words"] >= x["size"] for p in x["passes"])
    assert got == +expected and max(got.values()) == 2


def test_mix_reaches_its_target_with_repeated_rows(spark, tmp_path):
    """Rows that share id and text are taken each by its own place, from files and from memory."""
    docs = spark.createDataFrame([(None, "one two three four five " * 20, "en", "a", 1)] * 50 + [(1, "a b c d " * 25, "en", "a", 2)] * 20, SCHEMA)
    docs = docs.unionByName(spark.createDataFrame([(9, "w " * 10, "en", "b", 3)] * 30, SCHEMA))
    docs.repartition(3).write.parquet(f"{tmp_path}/docs")
    for given in (docs, spark.read.parquet(f"{tmp_path}/docs")):
        target = {r["source"]: r["target"] for r in mixing.mix(given, corpus_pipeline.SCHEDULES).select("source", "target").distinct().collect()}
        got = Counter()
        for x in run(spark, "mix", given).collect():
            got[x["source"]] += len(x["text"].split())
        assert all(abs(got[s] - t) <= 100 for s, t in target.items()), (got, target)


def test_piece_stage(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = {x["doc_id"]: x for x in run(spark, "pieces", frame(spark, rows(), SCHEMA)).collect()}
    for r in rows():
        assert got[r[0]]["ids"] == (None if r[1] is None else library.encode(r[1])) and got[r[0]]["round_trip"]


def test_whole_pipeline(spark):
    folder = f"{TESTDATA}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    parts = brute.near_duplicates(texts, 5, (80, 100))
    first = sorted(i for i, (_, c) in parts.items() if c == i and any(ch.isalpha() for ch in texts[i]))
    cut = brute.without_repeats([texts[i] for i in first], 35)
    left = {i for i, (n, gone, _) in zip(first, cut) if gone < n or not n}
    assert {x["doc_id"] for x in out} <= left and len({x["doc_id"] for x in out}) > 0.8 * len(left)
    assert all(x["round_trip"] for x in out)
    back = {x["doc_id"]: x["text"] for x in pieces.decode(spark.createDataFrame(out), ["doc_id"]).collect()}
    kept = {i: k for i, (_, _, k) in zip(first, cut)}
    assert all(brute.words(t) == kept[i] for i, t in back.items())


@pytest.mark.parametrize("name", ["language", "near_duplicates", "repeats", "mix", "pieces"])
def test_stages_on_an_empty_table(spark, name):
    assert run(spark, name, frame(spark, [], SCHEMA)).count() == 0


def test_rows_from_files_are_numbered_without_a_copy(spark, tmp_path):
    """Numbers are distinct, the same on every reading, and the near-duplicate stage gives the same rows from files."""
    given = rows([(None, "no id " * 9, "en", "a", 1), (1, "text b " * 9, "en", "a", 1), (2, "text b " * 9, "en", "a", 1)])
    docs = frame(spark, given, SCHEMA).withColumns({"code": F.lit(1), "_path": F.lit("p")})
    docs.repartition(5).write.parquet(f"{tmp_path}/docs")
    read = spark.read.parquet(f"{tmp_path}/docs")
    keyed, row = corpus_pipeline._keyed(read)
    first, again = ({x[row]: (x["doc_id"], x["text"]) for x in keyed.select(row, "doc_id", "text").collect()} for _ in range(2))
    assert len(first) == len(given) and first == again and keyed.columns == [*docs.columns, row]
    other = docs.drop("code", "_path")
    kept = Counter((x["doc_id"], x["text"]) for x in STAGES["near_duplicates"](spark, read, "").collect())
    assert kept == Counter((x["doc_id"], x["text"]) for x in run(spark, "near_duplicates", other).collect())
