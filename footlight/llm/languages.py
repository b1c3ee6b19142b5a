"""Language identification as inference of a mixture.

*Learning.*  The model holds, for every language, how often each letter trigram occurs (hashed into ``BUCKETS`` counts, so
its size is ``BUCKETS`` x languages).  It is fitted on about ``sample`` labelled documents per language, taken by a hash of
their ids, over whole texts.  That bound is the one sample here: every document is judged, on its whole text.

*Judging.*  A text is a bag of words (runs of letters).  A word's likelihood in a language is the product over its
trigrams.  Expectation-maximisation finds the language proportions under which the words are most likely, first over all
languages, then over the two, three, ... most frequent ones; the set with the best likelihood less half a logarithm of the
word count per language (BIC) is the document's, and its largest share the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.llm import textops

BUCKETS = 1 << 16
# More languages than this are refused: the model is sent to every task.
MOST_LANGUAGES = 256
_SLICE = 1 << 20
_SMOOTHING = 0.05
_ROUNDS, _MORE_ROUNDS = 10, 4
# A word counts at least this much in every language, relative to its best: misspellings decide nothing alone.
_FLOOR = 1e-4
UNDETERMINED = "und"
# Logarithmic likelihood of a letter's trigram when every one is as likely as any other.
BACKGROUND = -float(np.log(BUCKETS))


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case form of each letter of the basic plane, 0 for what is no letter."""
    out = np.zeros(1 << 16, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around every letter, whether the letter begins a word, and the row of each letter."""
    data, offsets = textops.utf8(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    table = _letters()
    low = table[np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        low[i] = points[i] if chr(points[i]).isalpha() else 0
    padded = np.zeros(len(low) + 2, np.uint64)
    padded[1:-1] = low
    before, after = padded[:-2].copy(), padded[2:].copy()
    edge = at[(at > 0) & (at < len(low))]
    before[edge] = 0
    after[edge - 1] = 0
    place = np.flatnonzero(low)
    key = (before[place] << np.uint64(42)) | (padded[1:-1][place] << np.uint64(21)) | after[place]
    bucket = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    return bucket, before[place] == 0, np.searchsorted(at, place, "right") - 1


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textops.slices(batch, "text", _SLICE):
            bucket, _, row = _trigrams(part.column("text"))
            codes = pc.dictionary_encode(part.column("lang"))
            cell = codes.indices.to_numpy()[row] * BUCKETS + bucket
            cells, n = np.unique(cell, return_counts=True)
            langs = codes.dictionary.take(pa.array(cells // BUCKETS))
            yield pa.RecordBatch.from_arrays([langs, pa.array(cells % BUCKETS), pa.array(n)], ["lang", "bucket", "n"])


def fit(labelled: DataFrame, id_column: str, text_column: str, lang_column: str, sample: int = 4000) -> tuple[list[str], np.ndarray]:
    """Languages in order and the logarithmic trigram frequencies, a row per bucket.

    Rows without a text or language teach nothing.  ``sample`` bounds the expected number of documents per language.
    """
    spark = labelled.sparkSession
    rows = labelled.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang")
    ).dropna(subset=["text", "lang"])
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs = sorted(r["lang"] for r in found)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    share = spark.createDataFrame([(r["lang"], min(1.0, sample / r["rows"])) for r in found], "lang string, share double")
    chance = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = rows.join(F.broadcast(share), "lang").where(chance < F.col("share")).select("lang", "text")
    sums = taken.mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # BUCKETS x MOST_LANGUAGES rows at most
    model = np.zeros((BUCKETS, len(langs)))
    at = {lang: i for i, lang in enumerate(langs)}
    where = np.array([at[x] for x in table.column("lang").to_pylist()], np.int64)
    model[table.column("bucket").to_numpy(), where] = table.column("n").to_numpy()
    model += _SMOOTHING
    return langs, np.log(model / model.sum(axis=0)).astype(np.float32)


def _mixture(p: np.ndarray, start: np.ndarray, counts: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after some rounds of expectation-maximisation, and each document's log-likelihood under them."""
    for _ in range(rounds):
        r = p * np.repeat(share, counts, axis=0)
        r /= r.sum(axis=1, keepdims=True)
        share = np.add.reduceat(r, start, axis=0) / counts[:, None]
    total = np.log((p * np.repeat(share, counts, axis=0)).sum(axis=1) + 1e-30)
    return share, np.add.reduceat(total.astype(np.float64), start)


def _infer(bucket: np.ndarray, begins: np.ndarray, row: np.ndarray, n: int, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (rows x languages, zero where not in the document's set) and the penalised likelihood per letter of each row."""
    shares, fits = np.zeros((n, model.shape[1])), np.full(n, -np.inf)
    words = np.bincount(row[begins], minlength=n) if len(row) else np.zeros(n, np.int64)
    docs = np.flatnonzero(words)
    if not len(docs) or not model.shape[1]:
        return shares, fits
    score = np.add.reduceat(model[bucket], np.flatnonzero(begins), axis=0)
    p = np.maximum(np.exp(score - score.max(axis=1, keepdims=True)), np.float32(_FLOOR))
    counts = words[docs]
    start = np.concatenate([[0], np.cumsum(counts)[:-1]])
    even = np.full((len(docs), p.shape[1]), 1 / p.shape[1], np.float32)
    full, fit_ = _mixture(p, start, counts, even, _ROUNDS)
    cost = np.log(np.maximum(counts, 2)) / 2
    best, best_value = full, fit_ - cost * p.shape[1]
    # Places of each document's languages by share; sets are nested, so more than a few are rarely worth their cost.
    order = np.argsort(-full, axis=1, kind="stable")
    undecided = np.arange(len(docs))
    for size in range(1, p.shape[1]):
        keep = np.zeros(full[undecided].shape, bool)
        np.put_along_axis(keep, order[undecided, :size], True, axis=1)
        part = np.where(keep, np.maximum(full[undecided], np.float32(1e-6)), np.float32(0))
        part /= part.sum(axis=1, keepdims=True)
        own = counts[undecided]
        own_start = np.concatenate([[0], np.cumsum(own)[:-1]])
        if len(undecided) == len(docs):
            own_p = p
        else:
            own_p = p[np.repeat(start[undecided] - own_start, own) + np.arange(own.sum())]
        got, value = _mixture(own_p, own_start, own, part.astype(np.float32), _MORE_ROUNDS if size > 1 else 0)
        value = value - cost[undecided] * size
        better = value > best_value[undecided] if size > 1 else np.ones(len(undecided), bool)
        first = size == 1
        chosen = undecided[better]
        whole_value = fit_[undecided] - cost[undecided] * p.shape[1]
        if first:
            keep_full = whole_value > value
            single = undecided[~keep_full]
            best[single], best_value[single] = got[~keep_full], value[~keep_full]
        else:
            best[chosen], best_value[chosen] = got[better], value[better]
        # A larger set can at most reach the likelihood of all languages.
        reach = fit_[undecided] - cost[undecided] * (size + 1)
        undecided = undecided[reach > best_value[undecided]]
        if not len(undecided):
            break
    shares[docs] = best
    most = np.add.reduceat(score.max(axis=1).astype(np.float64), start)
    fits[docs] = (best_value + most) / np.bincount(row, minlength=n)[docs]
    return shares, fits


def _judge(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, weights = model.value
        names = np.array([*langs, UNDETERMINED], dtype=object)
        for batch in batches:
            for part in textops.slices(batch, "_text", _SLICE):
                bucket, begins, row = _trigrams(part.column("_text"))
                shares, fits = _infer(bucket, begins, row, part.num_rows, weights)
                some = shares.sum(axis=1) > 0
                top = np.where(some, shares.argmax(axis=1) if len(langs) else 0, len(langs))
                value = np.where(some, shares.max(axis=1, initial=0), 0.0)
                order = np.argsort(-shares, axis=1, kind="stable")
                sizes = (shares > 0).sum(axis=1)
                pick = np.arange(len(langs))[None, :] < sizes[:, None]
                sets = names[order[pick]] if len(langs) else np.zeros(0, object)
                parts = np.take_along_axis(shares, order, axis=1)[pick]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c for k, c in zip(part.schema.names, part.columns) if k != "_text"],
                        pa.array(names[top], pa.string()),
                        pa.array(np.minimum(value, 1.0)),
                        textops.lists(sets, sizes, pa.string()),
                        textops.lists(parts, sizes, pa.float64()),
                        pa.array(fits - BACKGROUND),
                    ],
                    [*[k for k in part.schema.names if k != "_text"], "lang_pred", "score", "languages", "shares", "fit"],
                )

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str], text_column: str = "text") -> DataFrame:
    """Columns ``keep`` and lang_pred, score, languages, shares, fit: a row per row, without a shuffle.

    ``languages`` is the document's set by falling share, ``lang_pred`` its first, ``score`` that one's share.  A null
    text, one without a letter, or a model without languages gives ``und``, 0, empty lists and a fit of minus infinity.  Equal
    shares go to the language first in order.  ``fit`` is the set's likelihood per letter, less its penalty, against a background
    in which all trigrams are alike: below 0 the text is better explained by no language than by those of the model.
    """
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    named = docs.select(*keep, F.col(text_column).cast("string").alias("_text"))
    made = "lang_pred string, score double, languages array<string>, shares array<double>, fit double"
    return named.mapInArrow(_judge(sent), f"{kept}, {made}")
