"""Removal of passages that repeat anywhere, found by recompression.

A *window* is a fixed number of consecutive words of one document.  Every word covered by a window whose word sequence
also starts anywhere else goes.  Listing all windows would move the corpus many times over, so they are narrowed first:

1. **Recompression.**  Rounds of naming turn each document into ever fewer symbols: runs of one symbol get a name made of
   symbol and length, then pairs of a 0-symbol and a 1-symbol (a bit of the name) get a name made of both.  Names are
   64-bit hashes, so they are global: equal on all executors without a shuffle.  Each symbol carries the range of words
   that its borders and its name depend on.  A symbol whose range lies inside a window is the same wherever the window's
   words occur.
2. **Shared symbols.**  A window is represented by the lowest-named symbol that lies wholly inside it; windows next to
   each other mostly agree on it.  A window can only repeat if the words that this symbol depends on do, so Spark counts
   their names, and windows of unshared ones are done with.  A window without such a symbol (inside a long run) stays.
3. **Verification.**  The windows left are hashed word by word to 96 bits and counted.  Inside a slice of a task, equal
   windows are settled on the spot and sent once, so a passage that a third of all documents hold is few rows.
4. The words covered are cut from the texts.

Documents with equal texts are settled before: all their windows repeat, and one of them is looked at for the others' sake.
Texts cross the network compressed, once to be verified and once to be cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footlight.llm import textops
from footlight.operators.skew import lookup_join
from footlight.session import materialise

ROUNDS = 3
_ASK, _WITNESS, _CERTAIN = 0, 1, 2
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)


def _group(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where groups begin and end (exclusive), from a flag per element."""
    at = np.flatnonzero(first)
    return at, np.append(at[1:], len(first))


def recompress(h: np.ndarray, row: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the last round: their names, and the first and one past the last word that each depends on.

    ``h`` names the words, ``row`` tells the document of each.  A symbol at the edge of its document depends on a word
    beyond it, that is, on no word of any window.
    """
    name, doc = h, row
    low, high = np.arange(len(h)), np.arange(1, len(h) + 1)
    ends = np.cumsum(np.bincount(row)) if len(row) else low  # of documents
    before, beyond = np.concatenate([[0], ends])[:-1] - 1, ends + 1
    for round_ in range(rounds):
        if len(name) < 2:
            break
        head = np.ones(len(doc), bool)
        head[1:] = doc[1:] != doc[:-1]
        tail = np.append(head[1:], True)
        left = np.where(head, before[doc], np.concatenate([low[:1], low[:-1]]))
        right = np.where(tail, beyond[doc], np.concatenate([high[1:], high[-1:]]))
        new = head.copy()
        new[1:] |= name[1:] != name[:-1]
        a, b = _group(new)
        run = (b - a).astype(np.uint64)
        name, doc = np.where(run > 1, textops.mix(name[a] + run * np.uint64(0xD1B54A32D192ED03)), name[a]), doc[a]
        low, high = left[a], right[b - 1]

        bit = (textops.mix(name + np.uint64(round_ + 1)) & np.uint64(1)).astype(bool)
        head = np.ones(len(doc), bool)
        head[1:] = doc[1:] != doc[:-1]
        tail = np.append(head[1:], True)
        paired = np.zeros(len(doc), bool)  # with the symbol before
        paired[1:] = ~bit[:-1] & bit[1:] & ~head[1:]
        # A 0-symbol never joins the one before it, nor a 1-symbol the one after it, whatever those are.
        left = np.where(~bit, low, np.where(head, before[doc], np.concatenate([low[:1], low[:-1]])))
        right = np.where(bit, high, np.where(tail, beyond[doc], np.concatenate([high[1:], high[-1:]])))
        a, b = _group(~paired)
        two = b - a > 1
        name = np.where(two, textops.mix(textops.mix(name[a]) + name[b - 1]), name[a])
        doc, low, high = doc[a], left[a], right[b - 1]
    return name, low, high


def _representatives(h: np.ndarray, row: np.ndarray, window: int, rounds: int):
    """First words of all windows, the symbol that stands for each (-1: none), and the names of the symbols in use."""
    name, low, high = recompress(h, row, rounds)
    first = np.flatnonzero(row[: len(row) - window + 1] == row[window - 1 :]) if len(row) >= window else np.zeros(0, np.int64)
    chosen = np.full(len(first), -1)
    if not len(first):
        return first, chosen, name
    # Symbols i..j-1 lie inside a window; both ends only grow from window to window.
    i = np.cumsum(np.bincount(low + 2, minlength=len(h) + 3))[first + 1]
    j = np.cumsum(np.bincount(high, minlength=len(h) + 2))[first + window]
    some = np.flatnonzero(i < j)
    i, j = i[some], j[some]
    # Lowest key over ranges of 1, 2, 4, ... symbols; the low bits of a key are the place of its symbol.
    bits = np.uint64(max(len(name).bit_length(), 1))
    key = (textops.mix(name ^ np.uint64(0xA24BAED4963EE407)) >> bits << bits) | np.arange(len(name), dtype=np.uint64)
    level = np.frexp((j - i).astype(float))[1] - 1
    tables = [key]
    for k in range(int(level.max(initial=0))):
        last = tables[-1]
        tables.append(np.minimum(last, np.concatenate([last[1 << k :], np.full(min(1 << k, len(last)), _FAR)])))
    table = np.stack(tables)
    best = np.minimum(table[level, i], table[level, j - (1 << level)])
    chosen[some] = (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # What stands for a window is named by all words that its symbol depends on; they lie inside the window, too.
    full = np.zeros(len(name), np.uint64)
    used = np.unique(chosen[some])
    full[used] = textops.rolling(h, low[used], high[used] - low[used])
    return first, chosen, full


def _split(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, whether its name occurs again among these rows, and whether it is the first of such a name."""
    _, first, inverse, count = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    lead = np.zeros(len(name), bool)
    lead[first] = True
    return again, again & lead


def _batch(part: pa.RecordBatch, row: np.ndarray, name: np.ndarray, check: np.ndarray, kind: np.ndarray, s0: np.ndarray) -> pa.RecordBatch:
    """Rows to be counted.  Few and narrow columns, as these rows are most of what is shuffled."""
    mark = (check.astype(np.int64) << 32) | (kind.astype(np.int64) << 30) | s0
    keys = part.select(["id", "tk"]).take(pa.array(row))
    return pa.RecordBatch.from_arrays([*keys.columns, pa.array(name.view(np.int64)), pa.array(mark)], ["id", "tk", "name", "mark"])


def _starts_of(row: np.ndarray, n: int) -> np.ndarray:
    """Index of the first word of every document."""
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])[:n]


def _symbols(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch, "text"):
                data, offsets = textops.utf8(part.column("text"))
                starts, ends, row = textops.words(data, offsets)
                h = textops.hash_spans(data, starts, ends)
                first, chosen, name = _representatives(h, row, window, rounds)
                if not len(first):
                    continue
                # Windows next to each other with one symbol (or none) are one row.
                new = np.ones(len(first), bool)
                new[1:] = (chosen[1:] != chosen[:-1]) | (first[1:] != first[:-1] + 1)
                a, b = _group(new)
                s0, s1, chosen = first[a], first[b - 1], chosen[a]
                bare = chosen < 0
                names = np.where(bare, textops.mix(s0.astype(np.uint64)), name[np.maximum(chosen, 0)])
                again, lead = _split(names)
                kind = np.where(bare | again, _CERTAIN, _ASK)
                lead = np.flatnonzero(lead & ~bare)
                base = _starts_of(row, part.num_rows)[row[s0]]
                pick = np.concatenate([np.arange(len(s0)), lead])
                kind = np.concatenate([kind, np.full(len(lead), _WITNESS)])
                # Settled rows need no company: they are spread by a name of their own.
                names = np.where(kind == _CERTAIN, textops.mix(names[pick] + s0[pick].astype(np.uint64)), names[pick])
                yield _batch(part, row[s0][pick], names, (s1 - s0)[pick], kind, (s0 - base)[pick])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd", 5)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        raw = [None if t is None else t.encode() for t in texts]
        blobs = pa.array([None if r is None else codec.compress(r, asbytes=True) for r in raw], pa.binary())
        sizes = pa.array([None if r is None else len(r) for r in raw], pa.int64())
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], sizes, blobs], [*names, "size", "blob"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of packed rows with their texts; no more than one slice is unpacked at a time."""
    codec = pa.Codec("zstd")
    for batch in batches:
        sizes = batch.column("size").fill_null(0).to_numpy(zero_copy_only=False)
        ends, first, total = np.cumsum(sizes), 0, 0
        while first < len(sizes):
            last = max(int(np.searchsorted(ends, total + textops.SLICE_BYTES, "right")), first + 1)
            part = batch.slice(first, last - first)
            raw = zip(part.column("blob").to_pylist(), part.column("size").to_pylist())
            texts = [None if b is None else codec.decompress(b, n, asbytes=True) if n else b"" for b, n in raw]
            yield part.append_column("text", pa.array(texts, pa.binary()).cast(pa.string()))
            first, total = last, int(ends[last - 1])


def _ranges(part: pa.RecordBatch, column: str, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [s0, s1] of words of all rows, as indices into the slice's words."""
    values = part.column(column)
    counts = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = values.flatten()
    shift = np.repeat(base, counts)
    return flat.field("s0").to_numpy(zero_copy_only=False) + shift, flat.field("s1").to_numpy(zero_copy_only=False) + shift


def _covered(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in any range [a, b)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, a, 1)
    np.add.at(step, b, -1)
    return np.cumsum(step[:-1]) > 0


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _unpacked(batches):
            data, offsets = textops.utf8(part.column("text"))
            starts, ends, row = textops.words(data, offsets)
            base = _starts_of(row, part.num_rows)
            a, b = _ranges(part, "ranges", base)
            first = np.flatnonzero(_covered(a, b + 1, len(row)))
            if not len(first):
                continue
            h = textops.hash_spans(data, starts, ends)
            h1 = textops.rolling(h, first, window)
            h2 = (textops.rolling(textops.mix(h + np.uint64(77)), first, window) >> np.uint64(33)).astype(np.int64)
            again, lead = _split(h1)
            # Copies of a whole text are settled already: they only bear witness.
            whole = part.column("whole").to_numpy(zero_copy_only=False)[row[first]]
            ask, lead = np.flatnonzero(~again), np.flatnonzero(lead)
            settled = first[again & ~whole]
            new = np.ones(len(settled), bool)
            new[1:] = (settled[1:] != settled[:-1] + 1) | (row[settled[1:]] != row[settled[:-1]])
            x, y = _group(new)
            c0, c1 = settled[x], settled[np.maximum(y, 1) - 1] if len(x) else settled
            spread = textops.mix(c0.astype(np.uint64) + np.uint64(1))
            s0 = np.concatenate([first[ask], first[lead], c0])
            kind = np.concatenate([np.where(whole[ask], _WITNESS, _ASK), np.repeat([_WITNESS, _CERTAIN], [len(lead), len(c0)])])
            yield _batch(
                part,
                row[s0],
                np.concatenate([h1[ask], h1[lead], spread]),
                np.concatenate([h2[ask], h2[lead], c1 - c0]),
                kind,
                s0 - base[row[s0]],
            )

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _unpacked(batches):
            data, offsets = textops.utf8(part.column("text"))
            starts, ends, row = textops.words(data, offsets)
            n = part.num_rows
            a, b = _ranges(part, "ranges", _starts_of(row, n))
            gone = _covered(a, b + window, len(row))
            long = np.bincount(row, minlength=n) >= window
            gone |= (part.column("whole").to_numpy(zero_copy_only=False) & long)[row]
            # A word goes with the white space behind it.
            keep = ~_covered(starts[gone], np.append(np.minimum(starts[1:], offsets[row[:-1] + 1]), offsets[-1:])[gone], len(data))
            sizes = np.diff(np.concatenate([[0], np.cumsum(keep)])[offsets])
            at = np.concatenate([[0], np.cumsum(sizes)])
            kept = data[keep].tobytes()
            present = part.column("text").is_valid().to_pylist()
            texts = [kept[at[i] : at[i + 1]] if present[i] else None for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("rest"),
                    pa.array(np.bincount(row, minlength=n)),
                    pa.array(np.bincount(row[gone], minlength=n)),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["id", "rest", "n_words", "n_removed", "kept"],
            )

    return run


def _repeated(rows: DataFrame, exact: bool) -> DataFrame:
    """Per document its ranges that are settled or whose key has another row; at most one row of a key from a slice.

    ``exact`` keys hold the second hash; in the rows of symbols, and in settled rows, its place holds the length instead.
    """
    kind = F.shiftright("mark", 30).bitwiseAND(3)
    high = F.shiftright("mark", 32)
    company = F.count(F.when(kind != _CERTAIN, 1)).over(Window.partitionBy("name", *([high] if exact else [])))
    found = rows.withColumn("n", company).where((kind == _CERTAIN) | ((kind == _ASK) & (F.col("n") > 1)))
    length = F.when(kind == _CERTAIN, high).otherwise(0) if exact else high
    s0 = F.col("mark").bitwiseAND((1 << 30) - 1)
    both = F.struct(s0.cast("int").alias("s0"), (s0 + length).cast("int").alias("s1"))
    return found.groupBy("id", "tk").agg(F.collect_list(both).alias("ranges"))


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 35,
    rounds: int = ROUNDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(<id>, <keep>, n_words, n_removed, kept): each document without the words of windows that also start elsewhere.

    One row per row of ``docs``; ``kept`` is the text that remains, with its own white space; all copies of a passage go.
    Null texts have no words and stay null; texts shorter than the window stay as they are.  Rows that repeat an id are
    documents like any other: equal rows lose all their windows.  Ids may be null.  Other columns than ``keep`` are not read.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.col(text_column).cast("string")
    named = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text).alias("tk"),
        F.xxhash64(F.lit(7), text).alias("tk2"),
        text.alias("text"),
        F.struct(F.lit(0).alias("_"), *keep).alias("rest"),
    )
    # All windows of equal texts repeat: one of the texts bears witness for all.
    copies = named.where(text.isNotNull()).groupBy("tk", "tk2").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lead"))
    copies = materialise(copies.where(F.col("n") > 1), "copies")
    keyed = lookup_join(named, copies, ["tk", "tk2"], weight="n").withColumn("whole", F.col("n").isNotNull())
    asked = keyed.where(~F.col("whole") | F.col("id").eqNullSafe(F.col("lead"))).select("id", "tk", "text")
    rows = f"id {kind}, tk long, name long, mark long"
    symbols = asked.mapInArrow(_symbols(window, rounds), rows)
    rest = named.schema["rest"].dataType.simpleString()
    packed = keyed.select("id", "tk", "whole", "rest", "text").mapInArrow(
        _pack, f"id {kind}, tk long, whole boolean, rest {rest}, size long, blob binary"
    )

    def with_ranges(ranges: DataFrame, how: str) -> DataFrame:
        other = ranges.select(F.col("id").alias("_id"), F.col("tk").alias("_tk"), "ranges")
        met = F.col("id").eqNullSafe(F.col("_id")) & (F.col("tk") == F.col("_tk"))
        return packed.join(other, met, how).drop("_id", "_tk")

    windows = with_ranges(_repeated(symbols, False), "inner").mapInArrow(_windows(window), rows)
    cut = with_ranges(_repeated(windows, True), "left").mapInArrow(
        _cut(window), f"id {kind}, rest {rest}, n_words long, n_removed long, kept string"
    )
    kept = [F.col("rest")[c].alias(c) for c in keep]
    return cut.select(F.col("id").alias(id_column), *kept, "n_words", "n_removed", "kept")
