"""Benchmark decontamination by a broadcast set of hashed test windows.

1. **Windows.**  Texts are lower-cased (A-Z) and split into runs of digits, small letters and non-ASCII characters.  A test
   item gives every run of ``window`` consecutive words; a shorter item is one window.
2. **Set.**  Items are cut into overlapping chunks of at most ``CHUNK`` window starts, and chunks are dealt into parts of about
   ``PART_BYTES``.  Of one part at a time the sorted window hashes, the words themselves and the items of each window
   go to the executors; a benchmark of any size is that many parts, each scanned in turn.  The hash's seed is raised
   until no two different windows of a part share a hash.
3. **Scan.**  Every document, whole, is hashed window by window in one pass that moves no rows.  Windows whose hash is in the set
   are compared word by word with the test window, so a hit is certain.
4. **Removal.**  The words of all hits are marked; their stretches are cut from the text, or the document goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footlight.llm import textops
from footlight.session import materialise

PART_BYTES, CHUNK = 16 << 20, 1024
# Pairs of document and item that a task lists at once.
LISTED = 1 << 21

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = textops.lower_ascii(np.arange(256, dtype=np.uint8))
_FOLD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20


class Words(NamedTuple):
    """Folded bytes, where words begin and end in them, and the row of each word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray

    @classmethod
    def of(cls, column) -> tuple["Words", np.ndarray]:
        data, offsets = textops.utf8(column)
        folded = _FOLD[data]
        return cls(folded, *textops.words(folded, offsets)), offsets


def _same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether word ``i`` of ``a`` equals word ``j`` of ``b``, eight bytes at a time over all pairs."""
    size = a.ends[i] - a.starts[i]
    same = size == b.ends[j] - b.starts[j]
    left, right = (np.concatenate([w.data, np.zeros(8, np.uint8)]) for w in (a, b))
    at, rest = 0, np.flatnonzero(same)
    while len(rest):
        wide = np.minimum(size[rest] - at, 8)
        inside = np.arange(8) < wide[:, None]
        x = left[(a.starts[i[rest]] + at)[:, None] + np.arange(8)]
        y = right[(b.starts[j[rest]] + at)[:, None] + np.arange(8)]
        same[rest] = ((x == y) | ~inside).all(axis=1)
        at += 8
        rest = rest[same[rest] & (size[rest] > at)]
    return same


def _same_windows(a: Words, i: np.ndarray, b: Words, j: np.ndarray, length: int) -> np.ndarray:
    same = np.ones(len(i), bool)
    for k in range(length):
        rest = np.flatnonzero(same)
        same[rest] = _same_words(a, i[rest] + k, b, j[rest] + k)
    return same


class Windows(NamedTuple):
    """Distinct windows of one length: sorted hashes, a filter on their low bits, a first word of each, and items by window."""

    length: int
    hashes: np.ndarray
    filter: np.ndarray
    first: np.ndarray
    item_at: np.ndarray
    items: np.ndarray


class Part(NamedTuple):
    seed: int
    words: Words
    names: pa.Array
    windows: list[Windows]


def build_part(items: pa.Array, texts: pa.Array, window: int) -> Part:
    """The set of one part; a null item has windows but no name."""
    words, _ = Words.of(texts)
    coded = pa.chunked_array([items]).combine_chunks().dictionary_encode()
    item = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    of_row = np.minimum(np.bincount(words.row, minlength=len(texts)), window)
    seed = 0
    while True:
        h, made = textops.hash_spans(words.data, words.starts, words.ends, seed), []
        for length in np.unique(of_row[of_row > 0]).tolist():
            n = len(h) - length + 1
            first = np.flatnonzero((words.row[:n] == words.row[length - 1 :]) & (of_row[words.row[:n]] == length))
            key = textops.hash_runs(h, length)[first]
            hashes, at, entry = np.unique(key, return_index=True, return_inverse=True)
            if not _same_windows(words, first, words, first[at][entry], length).all():
                break
            named = item[words.row[first]] >= 0
            pairs = np.unique(np.stack([entry[named], item[words.row[first[named]]]], axis=1), axis=0)
            low = np.zeros(1 << max(16, (16 * len(hashes)).bit_length()), bool)
            low[(hashes & np.uint64(len(low) - 1)).astype(np.int64)] = True
            made.append(Windows(length, hashes, low, first[at], np.searchsorted(pairs[:, 0], np.arange(len(hashes) + 1)), pairs[:, 1]))
        else:
            return Part(seed, words, coded.dictionary, made)
        seed += 1


def _hits(part: Part, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """How the number of open hits changes before each word (one more entry at the end), and distinct (row, set, window)."""
    h = textops.hash_spans(words.data, words.starts, words.ends, part.seed)
    change, found = np.zeros(len(h) + 1, np.int64), [np.zeros((0, 3), np.int64)]
    for number, w in enumerate(part.windows):
        keys = textops.hash_runs(h, w.length)
        n = len(keys)
        if not n:
            continue
        at = np.flatnonzero(w.filter[(keys & np.uint64(len(w.filter) - 1)).astype(np.int64)] & (words.row[:n] == words.row[w.length - 1 :]))
        entry = np.minimum(np.searchsorted(w.hashes, keys[at]), len(w.hashes) - 1)
        known = w.hashes[entry] == keys[at]
        at, entry = at[known], entry[known]
        sure = _same_windows(words, at, part.words, w.first[entry], w.length)
        at, entry = at[sure], entry[sure]
        np.add.at(change, at, 1)
        np.add.at(change, at + w.length, -1)
        found.append(np.unique(np.stack([words.row[at], np.full(len(at), number), entry], axis=1), axis=0))
    return change, np.concatenate(found)


def _items(part: Part, found: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct items of each row: their numbers in a row, and how many each row has; ``LISTED`` pairs at a time."""
    counts, listed = np.zeros(rows, np.int64), [np.zeros(0, np.int64)]
    if not len(found):
        return listed[0], counts
    found = found[np.argsort(found[:, 0], kind="stable")]
    begin = np.zeros(len(found), np.int64)
    size = np.zeros(len(found), np.int64)
    for number, w in enumerate(part.windows):
        own = found[:, 1] == number
        begin[own] = w.item_at[found[own, 2]]
        size[own] = w.item_at[found[own, 2] + 1] - begin[own]
    heads = np.flatnonzero(np.diff(found[:, 0], prepend=-1))
    total = np.append(0, np.cumsum(np.add.reduceat(size, heads)))
    bounds, lo = np.append(heads, len(found)), 0
    while lo < len(heads):
        hi = max(int(np.searchsorted(total, total[lo] + LISTED, "right")) - 1, lo + 1)
        own = np.arange(bounds[lo], bounds[hi])
        row = np.repeat(found[own, 0], size[own])
        at = np.arange(len(row)) - np.repeat(np.cumsum(size[own]) - size[own], size[own]) + np.repeat(begin[own], size[own])
        which = np.repeat(found[own, 1], size[own])
        item = np.zeros(len(row), np.int64)
        for number, w in enumerate(part.windows):
            item[which == number] = w.items[at[which == number]]
        pairs = np.unique(np.stack([row, item], axis=1), axis=0)
        counts += np.bincount(pairs[:, 0], minlength=rows)
        listed.append(pairs[:, 1])
        lo = hi
    return np.concatenate(listed), counts


def _join_lists(a: pa.ListArray, values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Each list of ``a`` followed by its share of ``values``."""
    if not len(values):
        return a
    old = np.diff(a.offsets.to_numpy())
    both = pa.concat_arrays([a.flatten(), values])
    at = np.zeros(len(old) + 1, np.int32)
    np.cumsum(old + counts, out=at[1:])
    order = np.empty(len(both), np.int64)
    new = np.zeros(len(both), bool)
    inside = np.arange(len(both)) - np.repeat(at[:-1], old + counts)
    new[inside >= np.repeat(old, old + counts)] = True
    order[~new] = np.arange(len(both) - len(values))
    order[new] = np.arange(len(both) - len(values), len(both))
    return pa.ListArray.from_arrays(pa.array(at), both.take(pa.array(order)))


def _without(column: pa.Array, offsets: np.ndarray, words: Words, hit: np.ndarray) -> pa.Array:
    """The texts without the stretches from the first to the last word of each run of hit words."""
    before = np.append(False, hit[:-1] & (words.row[1:] == words.row[:-1])) if len(hit) else hit
    after = np.append(hit[1:] & (words.row[1:] == words.row[:-1]), False) if len(hit) else hit
    data, _ = textops.utf8(column)
    change = np.zeros(len(data) + 1, np.int8)
    np.add.at(change, words.starts[hit & ~before], 1)
    np.add.at(change, words.ends[hit & ~after], -1)
    keep = np.cumsum(change[:-1], dtype=np.int64) == 0
    kept_before = np.append(0, np.cumsum(keep))
    at = pa.array(kept_before[offsets], pa.int64())
    texts = pa.LargeStringArray.from_buffers(len(column), at.buffers()[1], pa.py_buffer(data[keep].tobytes()))
    return pa.compute.if_else(column.is_null(), pa.scalar(None, pa.large_string()), texts).cast(pa.string())


def _scan(part: Part, cut: bool, schema: pa.Schema | None = None):
    """Adds the hits of one part to (rest, text, runs, items); the last part also counts, and cuts the text if asked to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in textops.slices(batch, "text"):
                words, offsets = Words.of(piece.column("text"))
                n = piece.num_rows
                n_words = np.bincount(words.row, minlength=n)
                base = np.cumsum(n_words) - n_words
                change, found = _hits(part, words)
                runs = piece.column("runs")
                per_row = np.diff(runs.offsets.to_numpy())
                earlier = runs.flatten().to_numpy().astype(np.int64) + np.repeat(base, per_row)
                np.add.at(change, earlier[::2], 1)
                np.add.at(change, earlier[1::2], -1)
                hit = np.cumsum(change[:-1]) > 0
                same_row = words.row[1:] == words.row[:-1]
                opens = hit & ~np.append(False, hit[:-1] & same_row)[: len(hit)]
                closes = hit & ~np.append(hit[1:] & same_row, False)[: len(hit)]
                ends = np.stack([np.flatnonzero(opens), np.flatnonzero(closes) + 1], axis=1)
                rows = words.row[ends[:, 0]] if len(ends) else np.zeros(0, np.int64)
                flat = (ends - base[rows][:, None]).astype(np.int32).ravel()
                numbers, counts = _items(part, found, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("rest"),
                        _without(piece.column("text"), offsets, words, hit) if cut else piece.column("text"),
                        textops.lists(flat, 2 * np.bincount(rows, minlength=n), pa.int32()),
                        _join_lists(piece.column("items"), part.names.take(pa.array(numbers)), counts),
                        pa.array(n_words, pa.int64()),
                        pa.array(np.bincount(words.row[hit], minlength=n), pa.int64()),
                    ],
                    ["rest", "text", "runs", "items", "n_words", "n_hit"],
                )

    return run


def _chunks(benchmark: DataFrame, window: int, item_column: str, text_column: str) -> DataFrame:
    """(item, text): folded words joined by blanks, ``CHUNK`` window starts in each; chunks of an item overlap by a window."""
    folded = F.translate(F.col(text_column).cast("string"), _UPPER, _LOWER)
    words = benchmark.select(
        F.col(item_column).cast("string").alias("item"), F.filter(F.split(folded, _SEPARATORS), lambda w: w != "").alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)), F.lit(CHUNK))
    each = words.select("item", "words", F.explode(starts).alias("at"))
    return each.select("item", F.array_join(F.slice("words", F.col("at"), F.lit(CHUNK + window - 1)), " ").alias("text")).distinct()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    window: int = 10,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    remove: bool = False,
) -> DataFrame:
    """(rest, text, runs, items, n_words, n_hit) for every row of ``docs``; ``rest`` is a struct of the columns in ``keep``.

    ``runs`` holds begin and end of each run of hit words, ``items`` the ids, as strings, of the items of which a window occurs,
    sorted.  ``text`` is the text, without the hit stretches if ``remove``.  Null texts have no words and stay null; empty texts,
    repeated rows and empty tables need no care.  Benchmark rows that share an id are one item; null ids have windows, but are not listed.
    """
    if window < 1:
        raise ValueError("a window holds at least one word")
    chunks = materialise(_chunks(benchmark, window, item_column, item_text), "test_chunks")
    size = chunks.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = 1 + size // PART_BYTES
    rest = F.struct(F.lit(0).alias("_"), *keep)
    nothing = F.array().cast("array<int>").alias("runs"), F.array().cast("array<string>").alias("items")
    out = docs.select(rest.alias("rest"), F.col(text_column).cast("string").alias("text"), *nothing)
    kinds = f"rest {out.schema['rest'].dataType.simpleString()}, text string, runs array<int>, items array<string>"
    number = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for p in range(parts):
        rows = chunks.where(number == p).toArrow()
        part = build_part(rows.column("item").combine_chunks(), rows.column("text").combine_chunks(), window)
        last = p == parts - 1
        out = out.select("rest", "text", "runs", "items").mapInArrow(_scan(part, remove and last), f"{kinds}, n_words long, n_hit long")
    return out.withColumn("items", F.array_sort(F.array_distinct("items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, drop_documents: bool = False, **options) -> DataFrame:
    """``docs`` without what it shares with the benchmark: hit stretches are cut, or (``drop_documents``) hit documents go.

    Same columns and, when cutting, same rows; other columns may have any name.  ``options`` as for ``find_leaks``.
    """
    name = options.get("text_column", "text")
    others = [c for c in docs.columns if c != name]
    found = find_leaks(docs, benchmark, others, remove=not drop_documents, **options)
    if drop_documents:
        found = found.where(F.col("n_hit") == 0)

    def column(c: str) -> Column:
        return F.col("text").cast(docs.schema[c].dataType) if c == name else F.col("rest").getField(c)

    return found.select(*[column(c).alias(c) for c in docs.columns])
