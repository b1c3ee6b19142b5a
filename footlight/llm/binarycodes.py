"""Near-duplicate embeddings by randomly rotated binary codes with correction factors.

Vectors are compared inside their label (and length).  Equal vectors are one *class* from here on.

* **Candidates.**  A class lies in one bucket of each of several tables, by the signs of a few random projections per table.
  More projections make smaller buckets but need more tables: a pair at the threshold misses all of them with a chance of
  ``MISS``.  Their number is the one with the least work, pairs compared and classes sent; for a small label that is none.
* **Codes.**  A unit vector is rotated at random; its code is the signs of the result, its correction factor the inner product
  of code and rotated vector.  The inner product of one's code with the other's rotated vector, divided by the factor,
  estimates their cosine without bias; its error has a standard deviation known from the factor.  Pairs whose estimate lies
  more than ``SURE`` deviations below the threshold are done with; all others are recomputed in double precision.
* **Tiles.**  Large buckets are compared in tiles of at most about ``TILE`` x ``TILE`` classes.  A tile returns sums and one
  link per class, never pairs; a pair is counted in the first table in which it meets.
* **Names.**  A class has a number of its own, whatever ids its rows have; ids come back only to name the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.llm import textops
from footlight.llm.components import connected_components
from footlight.operators.skew import lookup_join
from footlight.session import materialise

TILE, STRIPE, PAIRS = 4096, 512, 1 << 16
MISS, SURE = 1e-6, 6.0
# Sending a class to one tile costs as much as estimating so many pairs.
SENT, MOST_BITS = 500, 40
_SEED = 977


def tables_for(classes: int, threshold: float) -> tuple[int, int]:
    """Projections per table and number of tables with the least work for a label of so many classes."""
    same = 1 - math.acos(min(threshold, 1.0)) / math.pi
    best = (math.inf, 0, 1)
    for bits in range(MOST_BITS + 1):
        tables = 1 if bits == 0 else max(1, math.ceil(math.log(MISS) / math.log1p(-min(same**bits, 1 - 1e-12))))
        bucket = classes / 2**bits
        work = tables * (classes * SENT * math.ceil(max(bucket / TILE, 1)) + classes * bucket / 2)
        best = min(best, (work, bits, tables))
    return best[1:]


def _rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([_SEED, d]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def _code(threshold: float):
    """Adds code, factor and the bucket of every table; vectors of one length at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("dim").to_numpy()
            count = batch.column("classes").to_numpy()
            for d, n in sorted(set(zip(size.tolist(), count.tolist()))):
                part = batch.filter(pa.array((size == d) & (count == n)))
                x = part.column("vec").flatten().to_numpy().reshape(part.num_rows, d)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                turned = unit @ _rotation(d).T
                signs = turned >= 0
                factor = np.abs(turned).sum(axis=1) / math.sqrt(d)
                bits, tables = tables_for(n, threshold)
                planes = np.random.default_rng([_SEED, d, 1]).standard_normal((d, max(bits * tables, 1)))
                side = (unit @ planes >= 0)[:, : bits * tables].reshape(part.num_rows, tables, bits)
                keys = (side * (1 << np.arange(bits))).sum(axis=2) if bits else np.zeros((part.num_rows, 1), np.int64)
                codes = [c.tobytes() for c in np.packbits(signs, axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in ("class", "label", "dim", "m", "vec")],
                        pa.array(codes, pa.binary()),
                        pa.array(factor),
                        textops.lists(keys.astype(np.int32).ravel(), np.full(part.num_rows, tables), pa.int32()),
                    ],
                    ["class", "label", "dim", "m", "vec", "code", "factor", "keys"],
                )

    return run


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of ``n`` is linked to, directly or through others."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(threshold: float):
    def run(key, table):
        d, place = key[1].as_py(), key[2].as_py()
        t1, t2 = key[4].as_py(), key[5].as_py()
        table = table.sort_by("class")
        n = table.num_rows
        names, tile, m, factor = (table.column(c).to_numpy() for c in ("class", "tile", "m", "factor"))
        vec = table.column("vec").combine_chunks().flatten().to_numpy().reshape(n, d)
        norm = np.linalg.norm(vec, axis=1)
        code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(n, -1)
        turned = ((vec / norm[:, None]) @ _rotation(d).T).astype(np.float32)
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(n, -1)
        deviation = np.sqrt(np.maximum(1 / factor**2 - 1, 0) * max(1 - threshold**2, 0) / max(d - 1, 1e-9)) + 1e-5
        left, right = np.flatnonzero(tile == t1), np.flatnonzero(tile == t2)
        links, one, two = np.zeros(n, np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(left), STRIPE):
            i = left[at : at + STRIPE]
            signs = np.unpackbits(code[i], axis=1, count=d).astype(np.float32) * 2 - 1
            estimate = (signs @ turned[right].T) / (math.sqrt(d) * factor[i])[:, None].astype(np.float32)
            maybe = estimate >= (threshold - SURE * deviation[i])[:, None]
            if t1 == t2:
                maybe &= right[None, :] > i[:, None]
            a, b = np.nonzero(maybe)
            a, b = i[a], right[b]
            for lo in range(0, len(a), PAIRS):
                x, y = a[lo : lo + PAIRS], b[lo : lo + PAIRS]
                sure = np.einsum("ij,ij->i", vec[x], vec[y]) >= threshold * norm[x] * norm[y]
                x, y = x[sure], y[sure]
                new = (keys[x] == keys[y]).argmax(axis=1) == place
                np.add.at(links, x[new], m[y[new]])
                np.add.at(links, y[new], m[x[new]])
                # As few pairs as connect what the stripe has found.
                root = _joined(n, np.append(one[-1], x), np.append(two[-1], y))
                tied = np.flatnonzero(root != np.arange(n))
                one[-1], two[-1] = tied, root[tied]
        root = _joined(n, one[-1], two[-1])
        some = np.flatnonzero((links > 0) | (root != np.arange(n)))
        return pa.table({"class": pa.array(names[some]), "links": pa.array(links[some]), "low": pa.array(names[root[some]])})

    return run


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(<id>, n_links, component_id, kept) for every row of ``vectors``.

    Two vectors are linked when their labels are equal and not null and their cosine, in double precision, is at least
    ``threshold`` (between 0 and 1).  Null or zero vectors, and those with null or non-finite components, link with nothing, and
    neither do vectors of different lengths.  Rows that repeat an id count each; a row without an id links with nothing, has
    no component and is kept.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies between 0 and 1")
    vec = F.col(vector_column).cast("array<double>")
    sound = ~F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists(vec, lambda c: c != 0)
    usable = F.coalesce(sound, F.lit(False)) & F.col(id_column).isNotNull() & F.col(label_column).isNotNull()
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"), F.when(usable, vec).alias("vec"))
    # Adding zero makes -0.0 and 0.0 one.
    rows = rows.withColumn("vec", F.transform("vec", lambda c: c + F.lit(0.0)))
    keys = ["label", "h1", "h2"]
    rows = rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec"), "dim": F.size("vec")})
    present = rows.where(F.col("vec").isNotNull())
    classes = present.groupBy(*keys, "dim").agg(F.min("id").alias("rep"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("m"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "vector_classes")
    labels = materialise(classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("classes")), "labels")
    named = lookup_join(classes.select("class", "label", "dim", "m", "vec"), labels, ["label", "dim"], weight="classes")
    made = "class long, label string, dim int, m long, vec array<double>, code binary, factor double, keys array<int>"
    coded = materialise(named.mapInArrow(_code(threshold), made), "coded")
    bucket = ["label", "dim", "place", "bucket"]
    placed = coded.select("*", F.posexplode("keys").alias("place", "bucket"))
    sizes = coded.select("label", "dim", F.posexplode("keys").alias("place", "bucket")).groupBy(*bucket)
    sizes = materialise(sizes.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "bucket_sizes")
    tiled = lookup_join(placed, sizes, bucket, weight="n", how="inner")
    tiled = tiled.withColumn("tiles", F.ceil(F.col("n") / F.lit(TILE)).cast("int"))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.withColumns({"t1": F.least("tile", "other"), "t2": F.greatest("tile", "other")})
    sent = tiled.select(*bucket, "t1", "t2", "tile", "class", "m", "vec", "code", "factor", "keys")
    found = sent.groupBy(*bucket, "t1", "t2").applyInArrow(_compare(threshold), "class long, links long, low long")
    found = materialise(found, "tile_links")
    components = connected_components(found.select("class", "low"), "class", "low").withColumnRenamed("node", "class")
    sums = found.groupBy("class").agg(F.sum("links").alias("links"))
    per_class = classes.select(*keys, "m", "rep", "class").join(sums, "class", "left").join(components, "class", "left")
    per_class = materialise(per_class.withColumn("component", F.coalesce("component", "class")), "named_classes")
    lowest = per_class.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    table = lookup_join(per_class, materialise(lowest, "lowest_ids"), ["component"], weight="_n")
    table = table.select(*keys, "m", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    out = lookup_join(rows.select("id", *keys, F.col("vec").isNotNull().alias("ok")), materialise(table, "per_class"), keys, weight="m")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_column),
        F.when(F.col("ok"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
