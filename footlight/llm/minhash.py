"""Near-duplicate documents: universal hash minima, banding, signature verification, exact confirmation, components.

1. Every document becomes the set of its word shingles; documents with equal sets are one *class* from here on, named by
   its smallest id, so a group of copies costs one row.
2. A class has ``bands * rows`` minima of universal hashes of its shingles.  Classes equal in all minima of a band share
   a bucket.  Two sets at the threshold miss every bucket with a chance of a few in a million.
3. In each bucket every class is compared with the bucket's centre.  Pairs whose signatures agree far too rarely go
   (``MARGIN`` standard deviations below the threshold); the others are confirmed on their full sets.
4. Buckets that still hold several components are compared in tiles of bounded size: pairs of classes from different
   components whose signatures agree are confirmed on full sets inside the tile, each pair once, until one link joins the
   two components.  So a large group is never one task, and a tile emits fewer links than it has classes.
5. Components come from alternating large-star and small-star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.llm import textops
from footlight.llm.components import connected_components
from footlight.operators.skew import lookup_join
from footlight.session import materialise

TILE = 256
MARGIN = 4.5
_SEED = 20240229


def _sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, all in a row, and how many each has."""
    data, offsets = textops.utf8(texts)
    data = textops.lower_ascii(data)
    starts, ends, row = textops.words(data, offsets)
    h = textops.hash_spans(data, starts, ends)
    n = len(offsets) - 1
    per_row = np.bincount(row, minlength=n)
    runs = textops.hash_runs(h, k)
    inside = row[: len(runs)] == row[k - 1 :] if len(runs) else np.zeros(0, bool)
    runs, run_row = runs[inside], row[: len(runs)][inside]
    short = np.flatnonzero((per_row > 0) & (per_row < k))
    if len(short):  # the whole sequence is the one shingle
        first = np.concatenate([[0], np.cumsum(per_row)])[short]
        whole = np.full(len(short), np.uint64(k), np.uint64)
        for i in range(k - 1):
            more = per_row[short] > i
            whole[more] = textops.mix(whole[more] + h[first[more] + i])
        runs, run_row = np.concatenate([runs, whole]), np.concatenate([run_row, short])
        order = np.argsort(run_row, kind="stable")
        runs, run_row = runs[order], run_row[order]
    counts = np.bincount(run_row, minlength=n)
    at = np.concatenate([[0], np.cumsum(counts)])
    for i in np.flatnonzero(counts > 1):
        runs[at[i] : at[i + 1]].sort()
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (run_row[1:] != run_row[:-1])
    return runs[new], np.bincount(run_row[new], minlength=n)


def _signatures(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(_SEED)
        a = rng.integers(0, 1 << 64, bands * rows, np.uint64) | np.uint64(1)
        b = rng.integers(0, 1 << 64, bands * rows, np.uint64)
        for batch in batches:
            for part in textops.slices(batch, "text"):
                x, n = _sets(part.column("text"), k)
                full = np.flatnonzero(n)
                at = np.concatenate([[0], np.cumsum(n[full])])[:-1]
                minima = np.zeros((bands * rows, len(n)), np.uint64)
                keys = np.zeros((2, len(n)), np.uint64)
                if len(full):
                    for i in range(bands * rows):
                        minima[i, full] = np.minimum.reduceat((x * a[i] + b[i]) >> np.uint64(32), at)
                    keys[0, full] = np.add.reduceat(textops.mix(x), at)
                    keys[1, full] = np.bitwise_xor.reduceat(textops.mix(x + np.uint64(1)), at)
                band = np.zeros((bands, len(n)), np.uint64)
                for i in range(bands):
                    band[i] = np.uint64(i)
                    for j in range(rows):
                        band[i] = textops.mix(band[i] + minima[i * rows + j])
                sig = np.ascontiguousarray(minima.T.astype(np.uint16))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(n, pa.int64()),
                        pa.array(keys[0].view(np.int64)),
                        pa.array(keys[1].view(np.int64)),
                        textops.lists(np.ascontiguousarray(band.T).ravel().view(np.int64), np.full(len(n), bands), pa.int64()),
                        pa.array([s.tobytes() for s in sig], pa.binary()),
                    ],
                    ["id", "n_shingles", "key1", "key2", "bands", "sig"],
                )

    return run


def _agreement(low: float):
    """Pairs whose signatures agree in a share of at least ``low``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                    for c in ("sig_a", "sig_b")
                )
                keep = pa.array((one == two).mean(axis=1) >= low)
                yield batch.select(["a", "b"]).filter(keep)

    return run


def _tile_links(low: float, bands: int, rows: int, share: tuple[int, int]):
    """Confirmed links of a tile between components, as few as connect them; a pair is met in its first band only."""

    def run(key, table):
        band, t1, t2 = (key[i].as_py() for i in (1, 2, 3))
        ids, tile, comp = (table.column(c).to_numpy() for c in ("id", "tile", "comp"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(ids), bands * rows)
        shingles = table.column("shingles").combine_chunks()
        at, values = shingles.offsets.to_numpy(), shingles.values.to_numpy().view(np.uint64)
        sizes = np.diff(at)
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        left, right = np.flatnonzero(tile == t1), np.flatnonzero(tile == t2)
        links: list[tuple[int, int]] = []
        for i in left:
            others = right[(comp[right] != comp[i]) & ((ids[right] > ids[i]) if t1 == t2 else True)]
            fit = share[1] * np.minimum(sizes[others], sizes[i]) >= share[0] * np.maximum(sizes[others], sizes[i])
            others = others[fit]
            same = sig[others] == sig[i]
            likely = same.mean(axis=1) >= low
            others, same = others[likely], same[likely]
            first = same.reshape(len(others), bands, rows).all(axis=2).argmax(axis=1)
            mine = values[at[i] : at[i + 1]]
            for j in others[first == band]:
                a, b = find(int(comp[i])), find(int(comp[j]))
                if a != b:
                    n = len(np.intersect1d(mine, values[at[j] : at[j + 1]], assume_unique=True))
                    if share[1] * n >= share[0] * int(sizes[i] + sizes[j] - n):
                        root[max(a, b)] = min(a, b)
                        links.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _shingles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch, "text"):
                x, n = _sets(part.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), textops.lists(x.view(np.int64), n, pa.int64())], ["id", "shingles"]
                )

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(two, "b").join(one, "a").select("a", "b", common.alias("n"), (F.size("sa") + F.size("sb")).alias("m"))
    return both.where(F.lit(share[1]) * F.col("n") >= F.lit(share[0]) * (F.col("m") - F.col("n"))).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    share: tuple[int, int] = (80, 100),
    bands: int = 32,
    rows: int = 5,
) -> DataFrame:
    """(<id>, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when their shingle sets have a Jaccard similarity of at least ``share[0] / share[1]``, as
    confirmed on the full sets.  A text with fewer than ``words`` words has its whole sequence as its one shingle.  Null,
    empty and blank texts have no shingles and link with nothing.  Rows that repeat an id count as the same document; a
    row without an id links with nothing, has no component and is kept.  Other columns are not read.
    """
    named = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    low = share[0] / share[1]
    low -= MARGIN * (low * (1 - low) / (bands * rows)) ** 0.5
    made = "id long, n_shingles long, key1 long, key2 long, bands array<long>, sig binary"
    every = materialise(named.mapInArrow(_signatures(words, bands, rows), made), "signatures")
    keys = ["key1", "key2", "n_shingles"]
    usable = every.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    classes = usable.groupBy(*keys).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = materialise(classes, "classes")
    # Two rows of one id may differ in text; either may stand for the class.
    heads = usable.join(classes.select(*keys, F.col("rep").alias("id")), [*keys, "id"]).dropDuplicates(["id", *keys])
    heads = materialise(heads.select("id", "bands", "sig"), "heads")

    placed = heads.select("id", F.posexplode("bands").alias("band", "bucket"))
    # The centre of a bucket is its smallest id.
    buckets = placed.groupBy("band", "bucket").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("n"))
    buckets = materialise(buckets.where(F.col("n") > 1), "buckets")
    members = materialise(lookup_join(placed, buckets, ["band", "bucket"], weight="n", how="inner"), "members")
    pairs = members.where(F.col("id") != F.col("centre")).select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    sigs = heads.select("id", "sig")
    signed = pairs.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b").join(
        sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a"
    )
    likely = materialise(signed.mapInArrow(_agreement(low), "a long, b long"), "likely_pairs")
    crowded = members.where(F.col("n") > 2)
    needed = likely.select(F.col("a").alias("id")).union(likely.select("b")).union(crowded.select("id")).distinct()
    texts = named.join(needed, "id", "left_semi").mapInArrow(_shingles(words), "id long, shingles array<long>")
    sets = materialise(texts.where(F.size("shingles") > 0).dropDuplicates(["id"]), "shingle_sets")
    links = materialise(_confirmed(likely, sets, share), "centre_links")

    found = materialise(connected_components(links), "components")
    labelled = crowded.select("band", "bucket", "n", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
    labelled = labelled.withColumn("comp", F.coalesce("component", "id")).drop("component")
    labelled = materialise(labelled, "labelled_members")
    mixed = labelled.groupBy("band", "bucket").agg(
        F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count(F.lit(1)).alias("m")
    )
    mixed = materialise(mixed.where(F.col("c1") != F.col("c2")).drop("c1", "c2"), "mixed_buckets")
    again = lookup_join(labelled.drop("n"), mixed, ["band", "bucket"], weight="m", how="inner")
    tiles = F.ceil(F.col("m") / F.lit(TILE)).cast("int")
    again = again.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    again = again.join(sigs, "id").join(sets, "id")
    again = again.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    again = again.withColumns({"t1": F.least("tile", "other"), "t2": F.greatest("tile", "other")})
    more = (
        again.select("bucket", "band", "t1", "t2", "tile", "id", "comp", "sig", "shingles")
        .groupBy("bucket", "band", "t1", "t2")
        .applyInArrow(_tile_links(low, bands, rows, share), "a long, b long")
    )
    links = links.unionByName(materialise(more, "tile_links"))

    found = materialise(connected_components(links), "components")
    named_classes = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    named_classes = named_classes.select(*keys, "n", F.coalesce("component", "rep").alias("component_id"))
    table = materialise(named_classes, "class_components")
    slim = every.select("id", *keys)
    out = lookup_join(slim, table, keys, weight="n")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
