"""Prefix trie of rebuilt conversations, by fingerprints that compose.

A conversation is rebuilt from the first turns of another one (its *head*, taken from its *base*) and its own turns behind as many.
No rebuilt text is ever made:

1. **Monoid.**  A turn is a map ``x -> m * x + a`` modulo 2**64, ``m`` odd, both from a digest of role and text.  A sequence's
   fingerprint is the composition of its turns, the pair (product of ``m``, ordered sum).  Odd numbers have inverses, so
   the fingerprint of a stretch follows from those of two prefixes, and a rebuilt prefix's from base head and own stretch.
2. **Prefixes.**  Turns, without their texts, are range-sorted by conversation and turn.  Every partition composes its rows in one
   pass; a conversation that runs over several partitions (at most two per partition do) is put together from their products.
3. **Nodes.**  Rebuilt prefixes are grouped by depth and fingerprint.  A group is verified by reference: its members must
   have one parent group and one last turn, and turns are one if role and text, compared whole where they are stored, are equal.
   Anything else raises the seed of the digests and starts over.
4. **Subtrees without levels.**  A node belongs to its smallest member; a conversation's nodes are the lower end of its path.
   So a subtree's sum is a sum over its members of what each owns, less what its owner owns above it.

The number of jobs does not depend on the depth.  One hot first turn is combined before the shuffle and joined as a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footlight.llm.textops import mix
from footlight.operators.skew import lookup_join
from footlight.session import materialise

NODE = ["depth", "m", "a"]
# Depths summed in one window; ids joined in one chunk.
LEVELS, CHUNK = 4096, 8192


def inverse(x: np.ndarray) -> np.ndarray:
    """Inverses of odd numbers modulo 2**64, by Newton's iteration: each step doubles the bits that are right."""
    out = x.copy()
    for _ in range(5):
        out *= np.uint64(2) - x * out
    return out


def turn_maps(x1: np.ndarray, x2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mix(x1.view(np.uint64)) | np.uint64(1), mix(x2.view(np.uint64))


def compose(first: tuple, then: tuple) -> tuple[np.ndarray, np.ndarray]:
    return first[0] * then[0], first[1] * then[0] + then[1]


def _u(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _i(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds number and fingerprint of the prefix that ends in each row, within conversation and partition."""
    block = TaskContext.get().partitionId()
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv").to_numpy()
        x1, x2 = (batch.column(c).to_numpy() for c in ("x1", "x2"))
        m, a = turn_maps(x1, x2)
        product = np.cumprod(m, dtype=np.uint64)
        back = inverse(product)
        total = np.cumsum(a * back, dtype=np.uint64)
        new = np.append(True, conv[1:] != conv[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        before = np.where(start > 0, back[start - 1], np.uint64(1))
        earlier = np.where(start > 0, total[start - 1], np.uint64(0))
        own = product * before, product * (total - earlier)
        pos = np.arange(n) - start + 1
        if last is not None and last[0] == conv[0]:
            goes_on = start == 0
            joined = compose(last[2:], own)
            own = tuple(np.where(goes_on, j, o) for j, o in zip(joined, own))
            pos = pos + np.where(goes_on, last[1], 0)
        last = conv[-1], pos[-1], own[0][-1:], own[1][-1:]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(np.full(n, block, np.int32)), pa.array(pos), _i(own[0]), _i(own[1]), batch.column("x1"), batch.column("x2"), batch.column("len")],
            ["conv", "block", "pos", "m", "a", "x1", "x2", "len"],
        )


def _offsets(table: pa.Table) -> pa.Table:
    """What precedes each block of one conversation."""
    table = table.sort_by("block")
    n = table.column("n").to_numpy()
    now, ms, sums = (np.ones(1, np.uint64), np.zeros(1, np.uint64)), [], []
    for m, a in zip(table.column("m").to_numpy().view(np.uint64), table.column("a").to_numpy().view(np.uint64)):
        ms.append(now[0][0])
        sums.append(now[1][0])
        now = compose(now, (np.array([m]), np.array([a])))
    return pa.table(
        {"conv": table.column("conv"), "block": table.column("block"), "pos0": pa.array(np.cumsum(n) - n), "m0": _i(np.array(ms)), "a0": _i(np.array(sums))}
    )


def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of the whole conversation from those of its blocks."""
    for b in batches:
        m, a = compose((_u(b, "m0"), _u(b, "a0")), (_u(b, "m"), _u(b, "a")))
        pos = b.column("pos").to_numpy() + b.column("pos0").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [b.column("conv"), pa.array(pos), _i(m), _i(a), b.column("x1"), b.column("x2"), b.column("len")],
            ["conv", "pos", "m", "a", "x1", "x2", "len"],
        )


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base head and own stretch composed: the stretch is what leads from the prefix left out to the row's prefix."""
    for b in batches:
        cut_m, cut_a, m, a = (_u(b, c) for c in ("cut_m", "cut_a", "m", "a"))
        own_m = m * inverse(cut_m)
        m, a = compose((_u(b, "head_m"), _u(b, "head_a")), (own_m, a - cut_a * own_m))
        turn_m, turn_a = turn_maps(b.column("x1").to_numpy(), b.column("x2").to_numpy())
        back = inverse(turn_m)
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in ("conv", "depth")], _i(m), _i(a), _i(m * back), _i((a - turn_a) * back), *[b.column(c) for c in ("x1", "x2", "len", "ends")]],
            ["conv", "depth", "m", "a", "pm", "pa", "x1", "x2", "len", "ends"],
        )


_REBUILT = "conv long, depth long, m long, a long, pm long, pa long, x1 long, x2 long, len long, ends boolean"


def _stored(conversations: DataFrame, names: tuple[str, str, str, str], seed: int) -> DataFrame:
    """Turns with the digest of role and text in two numbers of 60 bits."""
    conv, turn, role, text = (F.col(c) for c in names)
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(conv.isNotNull()).select(conv.cast("long").alias("conv"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    start = F.concat(F.lit(f"{seed}." if seed else ""), F.char_length("role").cast("string"), F.lit(":"))
    digest = F.md5(F.concat(start, "role", "text").cast("binary"))
    number = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return rows.withColumns({"x1": number(1), "x2": number(16), "len": F.char_length("text").cast("long")})


def _all_equal(stored: DataFrame, keyed: DataFrame) -> bool:
    """Whether turns with one digest have one role and text, compared whole."""
    often = keyed.groupBy("x1", "x2").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    often = materialise(often, "equal_turns")
    same = lookup_join(stored.select("x1", "x2", "role", "text"), often, ["x1", "x2"], weight="_n", how="inner")
    forms = same.groupBy("x1", "x2", "role", "text").agg(F.count(F.lit(1)).alias("_n"))
    return forms.groupBy("x1", "x2").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).isEmpty()


def _positions(keyed: DataFrame) -> DataFrame:
    """(conv, pos, m, a, x1, x2, len): number and fingerprint of every own prefix."""
    order = ["conv", F.col("turn").asc_nulls_first(), "x1", "x2", "salt"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "x1", "x2", "len")
    made = "conv long, block int, pos long, m long, a long, x1 long, x2 long, len long"
    local = materialise(ordered.mapInArrow(_prefixes, made), "prefixes")
    last = F.max_by(F.struct("m", "a"), "pos")
    blocks = local.groupBy("conv", "block").agg(F.max("pos").alias("n"), last.alias("last")).select("conv", "block", "n", "last.m", "last.a")
    blocks = materialise(blocks, "blocks")
    several = blocks.groupBy("conv").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("conv")
    # At most two conversations per partition run on: the table of their blocks has at most two rows per partition.
    over = blocks.join(several, "conv", "left_semi").groupBy("conv").applyInArrow(_offsets, "conv long, block int, pos0 long, m0 long, a0 long")
    joined = local.join(F.broadcast(materialise(over, "offsets")), ["conv", "block"], "left")
    joined = joined.fillna({"pos0": 0, "m0": 1, "a0": 0})
    return materialise(joined.mapInArrow(_shift, "conv long, pos long, m long, a long, x1 long, x2 long, len long"), "positions")


def _rebuilt(whole: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], longest: int) -> DataFrame:
    """One row per rebuilt conversation and depth, from 0: fingerprint, that of the depth before, the last turn's digest and length."""
    point = lambda m, a, x1, x2, n: F.struct(*[F.lit(v).cast("long").alias(k) if isinstance(v, int) else F.col(v).alias(k) for k, v in zip(("m", "a", "x1", "x2", "len"), (m, a, x1, x2, n))])
    root = point(1, 0, 0, 0, 0)
    cut = head(F.col("conv")).cast("long")
    first = F.collect_list(F.when(F.col("pos") <= longest, F.struct("pos", point("m", "a", "x1", "x2", "len").alias("at"))))
    convs = whole.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("pos") == cut, F.col("m"))).alias("cut_m"),
        F.max(F.when(F.col("pos") == cut, F.col("a"))).alias("cut_a"),
        F.transform(F.sort_array(first), lambda s: s["at"]).alias("own"),
    )
    convs = materialise(convs.withColumns({"base": base(F.col("conv")).cast("long"), "cut": cut}), "conversations")
    wanted = materialise(convs.where(F.col("cut") > 0).groupBy("base").agg(F.count(F.lit(1)).alias("uses")), "bases")
    heads = convs.select(F.col("conv").alias("base"), F.col("own").alias("head")).join(wanted, "base")
    joined = lookup_join(convs.drop("own"), materialise(heads, "heads"), ["base"], weight="uses")
    joined = joined.withColumn("head", F.when(F.col("cut") > 0, F.slice("head", F.lit(1), F.col("cut").cast("int"))))
    taken = F.coalesce(F.array_size("head"), F.lit(0)).cast("long")
    joined = joined.withColumn("taken", taken).withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("cut"), F.lit(0)))
    recs = materialise(joined.select("conv", "n", "cut", "cut_m", "cut_a", "head", "taken", "total"), "records")

    at = lambda i: F.when(i > 0, F.get("head", i - 1)).otherwise(root)
    steps = F.transform(F.sequence(F.lit(0), F.col("taken").cast("int")), lambda i: F.struct(i.alias("i"), at(i).alias("now"), at(i - 1).alias("up")))
    tops = recs.select("conv", "total", F.explode(steps).alias("s")).select(
        "conv", F.col("s.i").cast("long").alias("depth"), "s.now.m", "s.now.a", F.col("s.up.m").alias("pm"), F.col("s.up.a").alias("pa"),
        "s.now.x1", "s.now.x2", "s.now.len", (F.col("s.i") == F.col("total")).alias("ends"),
    )
    end = at(F.col("taken").cast("int"))
    sizes = recs.select(
        "conv", "n", "cut", F.coalesce("cut_m", F.lit(1)).alias("cut_m"), F.coalesce("cut_a", F.lit(0)).alias("cut_a"), "taken", "total",
        end["m"].alias("head_m"), end["a"].alias("head_a"),
    ).where(F.col("n") > F.col("cut"))
    own = lookup_join(whole, materialise(sizes, "stretches"), ["conv"], weight="n", how="inner").where(F.col("pos") > F.col("cut"))
    depth = F.col("taken") + F.col("pos") - F.col("cut")
    own = own.withColumns({"depth": depth, "ends": depth == F.col("total")}).drop("block").mapInArrow(_rebuild, _REBUILT)
    return materialise(tops.unionByName(own), "rebuilt")


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each node in order, ``CHUNK`` of them joined at a time."""
    for batch in batches:
        key = [batch.column(c).to_numpy() for c in NODE]
        ids = batch.column("conv").to_pylist()
        new = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in key], axis=0))) if ids else []
        spans = [(s, min(s + CHUNK, e)) for b, e in zip(new, [*new[1:], len(ids)]) for s in range(b, e, CHUNK)]
        heads = pa.array([s for s, _ in spans], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(heads) for c in (*NODE, "conv")], pa.array([",".join(map(str, ids[s:e])) for s, e in spans], pa.string())],
            [*NODE, "first", "ids"],
        )


def _digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its chunks, streamed."""
    now, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in now], pa.array([state.hexdigest()])], [*NODE, "ends_sha256"])

    for batch in batches:
        for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
            if key != now:
                if now is not None:
                    yield row()
                now, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
    if now is not None:
        yield row()


def _ends(members: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes in which several conversations end; ids are joined where a range sort puts them."""
    order = [*NODE, "conv"]
    ends = members.where(F.col("ends") & (F.col("n_ends") > 1)).select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    key = "depth long, m long, a long"
    chunks = materialise(ends.mapInArrow(_join_ids, f"{key}, first long, ids string"), "ends")
    chunks = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return chunks.mapInArrow(_digest_ids, f"{key}, ends_sha256 string")


def _owned_below(shared: DataFrame) -> DataFrame:
    """Adds ``below``: what the node's owner owns from this depth on.  Paths are summed in pieces of ``LEVELS``."""
    shared = shared.withColumn("piece", F.floor(F.col("depth") / F.lit(LEVELS)))
    pieces = shared.groupBy("owner", "piece").agg(F.sum("value").alias("_sum"))
    deeper = Window.partitionBy("owner").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("owner", "piece", F.coalesce(F.sum("_sum").over(deeper), F.lit(0)).alias("_deeper"))
    inside = Window.partitionBy("owner", "piece").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    out = shared.withColumn("_inside", F.sum("value").over(inside)).join(pieces, ["owner", "piece"])
    return out.withColumn("below", F.col("_inside") + F.col("_deeper")).drop("_inside", "_deeper", "piece")


def _nodes(rebuilt: DataFrame) -> DataFrame:
    same = ("pm", "pa", "x1", "x2", "len")
    return materialise(
        rebuilt.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv").alias("owner"),
            F.sum(F.col("ends").cast("long")).alias("n_ends"),
            F.min(F.when(F.col("ends"), F.col("conv"))).alias("end"),
            *[F.min(c).alias(c) for c in same],
            *[F.max(c).alias(f"{c}_max") for c in same],
        ),
        "nodes",
    )


def prefix_trie(
    conversations: DataFrame,
    base: Callable[[Column], Column],
    head: Callable[[Column], Column],
    longest_head: int,
    columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per trie node.

    Conversation ``c`` is rebuilt as the first ``head(c)`` turns (at most ``longest_head``) of conversation ``base(c)``, all if it has
    fewer, none if there is no such conversation, and its own turns behind its first ``head(c)``.  A node is a distinct sequence
    of turns that rebuilt conversations begin with, named by its smallest member and depth; the root has depth 0.

    Turns are ordered by turn (null first), ties by the MD5 of role and text.  Null roles and texts are empty, rows without an id
    belong to no conversation, repeated rows are turns each, an empty table has no nodes, other columns are left out.
    """
    seed = 0
    while True:
        stored = _stored(conversations, columns, seed)
        keyed = stored.select("conv", "turn", "x1", "x2", "len", F.monotonically_increasing_id().alias("salt"))
        keyed = materialise(keyed, "keyed_turns")
        rebuilt = _rebuilt(_positions(keyed), base, head, longest_head)
        nodes = _nodes(rebuilt)
        mixed = F.lit(False)
        for c in ("pm", "pa", "x1", "x2", "len"):
            mixed = mixed | (F.col(c) != F.col(f"{c}_max"))
        if nodes.where(mixed).isEmpty() and _all_equal(stored, keyed):
            break
        seed += 1

    shared = nodes.where(F.col("n") > 1).select(*NODE, "n", "owner", "n_ends", "len")
    shared = materialise(shared, "shared_nodes")
    members = lookup_join(rebuilt.select("conv", *NODE, "ends"), shared, NODE, weight="n", how="inner")
    members = members.withColumn("value", F.when(F.col("owner") == F.col("conv"), (F.col("n") - 1) * F.col("len")).otherwise(0))
    members = materialise(members, "members")
    leaf = F.when(F.col("ends"), ((F.col("owner") == F.col("conv")) & (F.col("n_ends") == F.col("n"))).cast("int"))
    owned = members.groupBy("conv").agg(F.sum("value").alias("owned"), F.coalesce(F.max(leaf), F.lit(1)).alias("leaf"), F.count(F.lit(1)).alias("_n"))
    each = lookup_join(members, materialise(owned, "owned"), ["conv"], weight="_n")
    sums = each.groupBy(*NODE).agg(
        *[F.min(c).alias(c) for c in ("n", "owner")],
        F.sum("value").alias("value"),
        F.sum("owned").alias("all_owned"),
        F.max(F.when(F.col("owner") == F.col("conv"), F.col("owned"))).alias("by_owner"),
        F.sum("leaf").alias("n_leaves"),
    )
    sums = _owned_below(sums).withColumn("saved", F.col("all_owned") - F.col("by_owner") + F.col("below"))
    children = nodes.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("pm").alias("m"), F.col("pa").alias("a"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    sums = sums.select(*NODE, "owner", "n_leaves", "saved").join(children, NODE, "left").join(_ends(members), NODE, "left")
    sums = materialise(sums.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "sums")

    many = nodes.where(F.col("n") > 1).join(sums.drop("owner"), NODE)
    alone = nodes.where(F.col("n") == 1).withColumns(
        {"n_leaves": F.lit(1).cast("long"), "saved": F.lit(0).cast("long"), "n_children": (F.col("n_ends") == 0).cast("long"), "ends_sha256": F.lit(None).cast("string")}
    )
    out = many.unionByName(alone).withColumn("up", F.col("depth") - 1)
    above = materialise(sums.select(F.col("depth").alias("up"), F.col("m").alias("pm"), F.col("a").alias("pa"), F.col("owner").alias("_above"), "n_children"), "parents")
    above = above.withColumnRenamed("n_children", "_n")
    out = lookup_join(out, above, ["up", "pm", "pa"], weight="_n")
    one = F.sha2(F.coalesce(F.col("end").cast("string"), F.lit("")), 256)
    return out.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("_above", "owner")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", one).alias("ends_sha256"),
    )
