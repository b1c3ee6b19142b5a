import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footlight.functions import cells, text


def column(spark, values, expression, schema="v string"):
    rows = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in rows.select(expression(F.col("v"))).collect()]


def expected_key(value):
    if not value:
        return ""
    ascii_text = unicodedata.normalize("NFKD", value.lower()).encode("ascii", "ignore").decode()
    return " ".join(sorted(set(re.sub(r"[^A-Za-z0-9_]+", " ", ascii_text.replace("-", "")).split())))


WORDS = ["Sci-Fi", "sci fi", "Fi, Sci", "Comédie", "", None, "!!!", "ﬁlm ½ … ℃ Ⅻ ㎏", "a b", "𝐀𝐛 Ｚ", "ß Þ İ K", "tab\tsep\x1cx", "-", " lead "]


def test_fingerprint_matches_its_definition(spark):
    assert column(spark, WORDS, text.fingerprint) == [expected_key(w) for w in WORDS]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=12), min_size=40, max_size=60))
def test_fingerprint_on_arbitrary_text(spark, values):
    assert column(spark, values, text.fingerprint) == [expected_key(v) for v in values]


def test_category_key_names_empty_values(spark):
    assert column(spark, ["Drama!", None, "??", ""], text.category_key) == ["drama", "unknown", "unknown", "unknown"]


def test_text_normalisation(spark):
    got = column(spark, ["  Große  Ærø ", "ÞORN ŁÓDŹ", "a\tb", "a \t b", "ÀÿÑ", None], text.normalise_text)
    assert got == ["grosse aero", "thorn lodŹ".lower(), "a\tb", "a b", "ayn", None]


def test_accents_have_one_plain_letter_each():
    assert len(text.ACCENTED) == len(text.PLAIN) == 53


def brute_ngrams(value):
    grams = []
    for w in (value or "").lower().split():
        w = f" {w} "
        for n in range(2, min(4, len(w)) + 1):
            grams += [w[i : i + n] for i in range(len(w) - n + 1)]
    return grams


def test_char_ngrams(spark):
    values = ["a", "ab abc", "  Word  ", "", None, "x y"]
    assert [sorted(g) for g in column(spark, values, text.char_ngrams)] == [sorted(brute_ngrams(v)) for v in values]


def test_ngram_counts_add_up(spark):
    values = ["the cat", "The hat the", None]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["ngram"]: r["n"] for r in text.ngram_counts(rows, "v").collect()}
    everything = [g for v in values for g in brute_ngrams(v)]
    assert got == {g: everything.count(g) for g in everything}


def test_null_markers_keep_spacing_of_other_cells(spark):
    assert column(spark, [",,", "", "  ", " ,, ", " x ", None], cells.null_if_marker) == [None, None, None, None, " x ", None]


def test_int_cast(spark):
    values = ["7", " 7 ", "7.0", "7.", "-3.25", "1.2e6", "n/a", "99999999999", "+5", ".5", None]
    assert column(spark, values, cells.to_int) == [7, 7, 7, 7, -3, None, None, None, 5, None, None]


def test_double_cast(spark):
    assert column(spark, ["1e3", "-.5", "x", None], cells.to_double) == [1000.0, -0.5, None, None]


def test_number_shapes(spark):
    values = ["7", "7.0", "7.", "1_000", "1e3", "7.5", "-2", "abc", "nan"]
    assert column(spark, values, cells.looks_int) == [True, True, True, True, False, False, True, False, False]
    assert column(spark, values, cells.looks_float) == [True, True, True, True, True, True, True, False, True]


def test_label_words(spark):
    values = ["YES", "True", "1", "1.0", "no", "FALSE", "0", "0.0", "maybe", None]
    assert column(spark, values, cells.label_word) == ["1"] * 4 + ["0"] * 4 + [None, None]


def test_year_repair(spark):
    rows = spark.createDataFrame([(None, "1999"), (None, "199"), ("1990", "1999"), (None, None)], "s string, e string")
    start, end = cells.repaired_years(F.col("s"), F.col("e"))
    got = [tuple(r) for r in rows.select(start.alias("a"), end.alias("b")).collect()]
    assert got == [("1999", None), (None, "199"), ("1990", "1999"), (None, None)]


def test_ratio_and_product(spark):
    rows = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (4.0, None), (None, 2.0)], "a double, b double")
    got = rows.select(cells.guarded_ratio(F.col("a"), F.col("b")), cells.product_or_zero(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(2.0, 8.0), (0.0, 0.0), (0.0, 0.0), (None, 0.0)]
