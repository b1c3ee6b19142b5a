"""Text normalisation as JVM-side column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Letters written as several ASCII letters, and accented letters with their plain form (same position).
EXPANSIONS = {
    "ß": "ss",
    "æ": "ae",
    "Æ": "AE",
    "œ": "oe",
    "Œ": "OE",
    "þ": "th",
    "Þ": "Th",
    "ð": "d",
    "Ð": "D",
    "ł": "l",
    "Ł": "L",
}
ACCENTED = "ÀÁÂÃÄÅàáâãäåÒÓÔÕÖØòóôõöøÈÉÊËèéêëÇçÌÍÎÏìíîïÙÚÛÜùúûüÿÑñ"
PLAIN = "AAAAAAaaaaaaOOOOOOooooooEEEEeeeeCcIIIIiiiiUUUUuuuuyNn"
UNKNOWN = "unknown"
# ----------------------------------------------------------------------------


def _replace_each(text: Column, pairs: dict[str, str]) -> Column:
    """Replace every key by its value, folding over one constant table however many pairs there are."""
    keys, values = (F.split(F.lit("\t".join(side)), "\t") for side in (pairs.keys(), pairs.values()))
    table = F.arrays_zip(keys.alias("k"), values.alias("v"))
    return F.aggregate(table, text, lambda acc, e: F.replace(acc, e["k"], e["v"]))


def normalise_text(text: Column) -> Column:
    """Trim, squeeze runs of two or more blanks, spell out special letters, drop accents, lower-case."""
    squeezed = F.regexp_replace(F.trim(text), r"\s{2,}", " ")
    spelled = F.when(text.rlike("[" + "".join(EXPANSIONS) + "]"), _replace_each(squeezed, EXPANSIONS)).otherwise(squeezed)
    return F.lower(F.translate(spelled, ACCENTED, PLAIN))


@lru_cache(maxsize=1)
def _ascii_folding() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition leaves ASCII: one-to-one (source, target) and one-to-many."""
    single, plain, several = [], [], {}
    for code in range(128, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        folded = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            single.append(char)
            plain.append(folded)
        elif folded:
            several[char] = folded
    return "".join(single), "".join(plain), several


def fold_to_ascii(text: Column) -> Column:
    """Compatibility-decompose, then drop whatever is not ASCII.

    Letters with a one-letter form are mapped first; the long replacement table is applied only to rows in
    which one of its characters is left.  (A hashed ``translate`` finds them: a regex class of hundreds of
    characters would test each one per character of text.)
    """
    single, plain, several = _ascii_folding()
    mapped = F.translate(text, single, plain)
    left = F.regexp_replace(mapped, r"[\x00-\x7F]+", "")
    spelled = F.when(F.translate(left, "".join(several), "") != left, _replace_each(mapped, several)).otherwise(mapped)
    return F.regexp_replace(spelled, r"[^\x00-\x7F]+", "")


def fingerprint(text: Column) -> Column:
    """Order-, case-, accent- and punctuation-insensitive key: the sorted distinct tokens; '' for null."""
    lowered = F.lower(text)
    plain = F.when(text.rlike(r"[^\x00-\x7F]"), fold_to_ascii(lowered)).otherwise(lowered)
    spaced = F.regexp_replace(F.replace(plain, F.lit("-"), F.lit("")), r"[^\w]+", " ")
    tokens = F.array_sort(F.array_distinct(F.split(spaced, " ")))
    # The empty token, if any, sorts first.
    return F.coalesce(F.trim(F.array_join(tokens, " ")), F.lit(""))


def category_key(text: Column) -> Column:
    """Fingerprint with null and empty values named 'unknown'."""
    return F.regexp_replace(fingerprint(text), "^$", UNKNOWN)


# Every character that counts as a blank in Unicode text (fixed value).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _split_words(text: Column) -> Column:
    """Lower-cased pieces between blanks, empty ones included; one character to split at is much faster than a class."""
    return F.split(F.translate(F.lower(text), BLANKS, " " * len(BLANKS)), " ")


def words(text: Column) -> Column:
    """Lower-cased blank-separated words."""
    return F.filter(_split_words(text), lambda w: w != "")


def word_ngrams(word: Column, shortest: int = 2, longest: int = 4) -> Column:
    """Character n-grams of one word padded with a blank on each side; no gram is longer than the padded word."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    size = F.length(padded)
    sizes = F.sequence(F.lit(shortest), F.least(F.lit(longest), size))
    return F.flatten(
        F.transform(
            sizes,
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda start: F.substring(padded, start, n)),
        )
    )


def char_ngrams(text: Column, shortest: int = 2, longest: int = 4) -> Column:
    """All word-bounded character n-grams of a text, with repeats; empty for a null or blank text."""
    grams = F.flatten(F.transform(words(text), lambda w: word_ngrams(w, shortest, longest)))
    return F.coalesce(grams, F.array().cast("array<string>"))


def ngram_counts(df: DataFrame, column: str, shortest: int = 2, longest: int = 4) -> DataFrame:
    """(ngram, n) over all texts.  Words are counted first, so each distinct word is cut once."""
    found = df.select(F.explode(_split_words(F.col(column))).alias("word")).where(F.col("word") != "")
    counted = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    grams = counted.select(F.explode(word_ngrams(F.col("word"), shortest, longest)).alias("ngram"), "n")
    return grams.groupBy("ngram").agg(F.sum("n").alias("n"))
