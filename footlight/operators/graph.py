"""Features of the bipartite person-title graph, kept as edge tables (tconst, nconst).

Edges may repeat; repeats count (``dedupe=True`` counts each edge once).

Titles with at most ``CROWD`` edges are *small*: their pairs are listed, a bounded number per edge.  The rest are *crowds*, at
most edges/CROWD of them, and are solved through persons' credit profiles over the crowds (see ``_crowd_weights``): people
with equal profiles are one, profiles that cannot beat what is known are dropped, and the others meet under several common
crowds at once instead of one (see ``_raise_floor``), unless their tiles of profiles are cheaper to multiply out (``_tile``).
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footlight.operators.skew import HOT_SHARE, lookup_join
from footlight.session import materialise

CROWD = 128
# Pairs that a tile compares in about the time that a row of a further round takes.
FEW_PAIRS = 500
# Pairs of profiles in one tile of a bucket, and the largest number of tasks that the tiles are dealt to.
TASK_PAIRS = 4 << 20
MOST_TASKS = 2_000
# Common titles of pairs that a tile lists at once.
BLOCK = 1 << 20
_KEYS = ["tconst", "nconst"]


def _edges(relation: DataFrame, dedupe: bool) -> DataFrame:
    edges = relation.select(*_KEYS)
    return edges.distinct() if dedupe else edges


def _multiplicities(edges: DataFrame) -> DataFrame:
    """(tconst, nconst, m): combined on the map side, and spread over both keys, so no hot title or person gathers."""
    return edges.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("m"))


def person_degree(relation: DataFrame, dedupe: bool = False) -> DataFrame:
    """(nconst, degree): edges per person."""
    return _edges(relation, dedupe).groupBy("nconst").agg(F.count(F.lit(1)).alias("degree"))


def degree_features(relation: DataFrame, prefix: str, dedupe: bool = False) -> DataFrame:
    """(tconst, <prefix>_avg_centrality, <prefix>_count): mean degree and number of a title's people.

    The join leaves the edges where they are or splits hot people off (see ``lookup_join``), and the sums of a
    hot title are combined per map task: the edges cross the network at most once before that.
    """
    edges = _edges(relation, dedupe)
    degrees = materialise(person_degree(edges.where(F.col("nconst").isNotNull())), "degree")
    return (
        lookup_join(edges, degrees, ["nconst"], weight="degree")
        .groupBy("tconst")
        .agg(F.avg("degree").alias(f"{prefix}_avg_centrality"), F.count("nconst").alias(f"{prefix}_count"))
    )


def same_role_pair_counts(relation: DataFrame, dedupe: bool = False) -> DataFrame:
    """(tconst, n_pairs): pairs of different people per title, each unordered pair of edges once, by formula."""
    per_person = _multiplicities(_edges(relation, dedupe)).where(F.col("tconst").isNotNull() & F.col("nconst").isNotNull())
    size, squares = F.sum("m"), F.sum(F.col("m") * F.col("m"))
    pairs = ((size * size - squares) / 2).cast("long")
    return per_person.groupBy("tconst").agg(pairs.alias("n_pairs")).where(F.col("n_pairs") > 0)


def cross_role_pair_counts(role_a: DataFrame, role_b: DataFrame, dedupe: bool = False) -> DataFrame:
    """(tconst, n_pairs): combinations of one edge of each role per title."""
    a = _edges(role_a, dedupe).groupBy("tconst").agg(F.count(F.lit(1)).alias("n_a"))
    b = _edges(role_b, dedupe).groupBy("tconst").agg(F.count(F.lit(1)).alias("n_b"))
    return a.join(b, "tconst").select("tconst", (F.col("n_a") * F.col("n_b")).alias("n_pairs"))


def same_role_weight(relation: DataFrame, prefix: str, dedupe: bool = False, crowd: int = CROWD) -> DataFrame:
    """(tconst, <prefix>_<prefix>_max_collab_weight): credits shared by the title's most frequent pair of one role."""
    edges = _edges(relation, dedupe).dropna().withColumn("side", F.lit(0))
    return _max_pair_weight(edges, True, f"{prefix}_{prefix}_max_collab_weight", crowd)


def cross_role_weight(
    role_a: DataFrame, role_b: DataFrame, prefix_a: str, prefix_b: str, dedupe: bool = False, crowd: int = CROWD
) -> DataFrame:
    """(tconst, <a>_<b>_max_collab_weight): credits shared by the title's most frequent pair across two roles."""
    a = _edges(role_a, dedupe).withColumn("side", F.lit(0))
    b = _edges(role_b, dedupe).withColumn("side", F.lit(1))
    edges = a.unionByName(b).dropna()
    return _max_pair_weight(edges, False, f"{prefix_a}_{prefix_b}_max_collab_weight", crowd)


def _small_pairs(edges: DataFrame, same: bool, lead: bool = False) -> DataFrame:
    """(tconst, p1, p2) for every pair of edges of small titles; the arrays hold at most CROWD people.

    ``lead`` adds a column of that name: true for one pair of each title (and its repeats).
    """
    if same:
        people = edges.groupBy("tconst").agg(F.array_sort(F.collect_list("nconst")).alias("people"))
        first = people.where(F.size("people") > 1).select("tconst", "people", F.posexplode("people").alias("at", "p1"))
        rest = F.slice("people", F.col("at") + 2, F.size("people"))
        ends = [F.element_at("people", i) for i in (1, -1)]
        pairs = first.select("tconst", "p1", F.explode(rest).alias("p2"), *[e.alias(f"_end{i}") for i, e in enumerate(ends)])
        pairs = pairs.where(F.col("p1") < F.col("p2"))
    else:
        people = edges.groupBy("tconst").agg(
            F.collect_list(F.when(F.col("side") == 0, F.col("nconst"))).alias("left"),
            F.collect_list(F.when(F.col("side") == 1, F.col("nconst"))).alias("right"),
        )
        first = people.where((F.size("left") > 0) & (F.size("right") > 0))
        ends = [F.element_at("left", 1).alias("_end0"), F.element_at("right", 1).alias("_end1")]
        pairs = first.select("tconst", "right", *ends, F.explode("left").alias("p1")).select("tconst", "p1", F.explode("right").alias("p2"), "_end0", "_end1")
    marked = [((F.col("p1") == F.col("_end0")) & (F.col("p2") == F.col("_end1"))).alias("lead")] if lead else []
    return pairs.select("tconst", "p1", "p2", *marked)


def _max_pair_weight(edges: DataFrame, same: bool, name: str, crowd: int) -> DataFrame:
    sizes = edges.groupBy("tconst").agg(F.count(F.lit(1)).alias("size"))
    crowds = materialise(sizes.where(F.col("size") > crowd), "crowds")
    if crowds.isEmpty():
        return _only_small_weights(edges, same, name)

    tagged = lookup_join(edges, crowds, ["tconst"], weight="size")
    small = tagged.where(F.col("size").isNull()).drop("size")
    profiles = tagged.where(F.col("size").isNotNull()).groupBy("side", *_KEYS).agg(F.count(F.lit(1)).alias("m"))
    profiles = materialise(profiles, "crowd_profiles")
    pairs = _small_pairs(small, same)
    listed = materialise(pairs.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n")), "listed_pairs")
    shared = materialise(_shared_crowds(listed, profiles, same), "shared_crowds")
    # Listed pairs with their credits in crowds added.
    extra = shared.groupBy("p1", "p2").agg(F.sum("credits").alias("extra"))
    totals = materialise(
        listed.join(extra, ["p1", "p2"], "left").select(
            "p1", "p2", "n", (F.col("n") + F.coalesce(F.col("extra"), F.lit(0))).alias("weight")
        ),
        "pair_totals",
    )
    in_small = _small_title_weights(pairs, totals, name)
    in_crowds = shared.join(totals, ["p1", "p2"]).groupBy("tconst").agg(F.max("weight").alias(name))
    only_crowds = _crowd_weights(profiles, same, name)
    return in_small.unionByName(in_crowds.unionByName(only_crowds).groupBy("tconst").agg(F.max(name).alias(name)))


def _only_small_weights(edges: DataFrame, same: bool, name: str) -> DataFrame:
    """Per title the largest weight of its pairs, where all titles are small: the pairs cross the network once.

    Pairs are counted where they meet.  Of those met once a title sends a single one on: they all weigh 1.  A pair is hot only
    if both its people are, fewer than ``HOT_SHARE`` of them; such pairs are counted on the map side first and looked up.
    """
    pairs = _small_pairs(edges, same, True)
    degree = materialise(edges.groupBy("nconst").agg(F.count(F.lit(1)).alias("n")), "edge_degree")
    total = degree.agg(F.sum("n")).first()[0] or 0
    hot = materialise(degree.where(F.col("n") * HOT_SHARE > total).select("nconst"), "hot_people")
    cold, found = pairs, []
    if not hot.isEmpty():
        for p in ("p1", "p2"):
            pairs = pairs.join(F.broadcast(hot.select(F.col("nconst").alias(p), F.lit(True).alias(f"_{p}"))), p, "left")
        both = F.col("_p1").isNotNull() & F.col("_p2").isNotNull()
        cold = pairs.where(~both)
        found.append(_small_title_weights(pairs.where(both).select("tconst", "p1", "p2"), None, name))
    met = cold.select("tconst", "lead", F.count(F.lit(1)).over(Window.partitionBy("p1", "p2")).alias(name))
    # The lead of a title may be among its hot pairs, which are all looked up.
    found.append(met.where((F.col(name) > 1) | F.col("lead")).select("tconst", name))
    return reduce(DataFrame.unionByName, found).groupBy("tconst").agg(F.max(name).alias(name))


def _small_title_weights(pairs: DataFrame, totals: DataFrame | None, name: str) -> DataFrame:
    """Per small title the largest weight of its pairs.

    Only pairs met more than once are looked up: every other pair of a title weighs 1.
    """
    if totals is None:
        totals = pairs.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n")).withColumn("weight", F.col("n"))
    recurring = materialise(totals.where(F.col("weight") > 1), "recurring_pairs")
    weighed = lookup_join(pairs, recurring, ["p1", "p2"], weight="n")
    return weighed.groupBy("tconst").agg(F.max(F.coalesce(F.col("weight"), F.lit(1))).alias(name))


def _shared_crowds(listed: DataFrame, profiles: DataFrame, same: bool) -> DataFrame:
    """(p1, p2, tconst, credits): crowds in which both people of a listed pair take part."""
    left = profiles.where(F.col("side") == 0).select(F.col("nconst").alias("p1"), "tconst", F.col("m").alias("m1"))
    right = profiles.where(F.col("side") == (0 if same else 1))
    right = right.select(F.col("nconst").alias("p2"), "tconst", F.col("m").alias("m2"))
    both = listed.select("p1", "p2").join(left, "p1").join(right, ["p2", "tconst"])
    return both.select("p1", "p2", "tconst", (F.col("m1") * F.col("m2")).alias("credits"))


def _crowd_weights(profiles: DataFrame, same: bool, name: str) -> DataFrame:
    """Per crowd the largest weight over crowds alone, comparing profiles rather than people.

    People credited in the same crowds equally often are interchangeable: they share a profile, named by an
    order-free 128-bit hash of its entries and represented by one person.  A pair that shares a single crowd weighs
    a product of two credit counts: the two largest decide.  Pairs of profiles that share several are searched by
    ``_raise_floor``.
    """
    hashes = [F.bit_xor(F.xxhash64("tconst", "m")), F.bit_xor(F.xxhash64(F.lit("second"), "m", "tconst"))]
    people = profiles.groupBy("side", "nconst").agg(
        F.concat_ws(":", *hashes).alias("kind"), F.sum(F.col("m") * F.col("m")).alias("norm"), F.count(F.lit(1)).alias("spans")
    )
    kinds = people.groupBy("side", "kind", "norm", "spans").agg(
        F.count(F.lit(1)).alias("heads"), F.min("nconst").alias("nconst")
    )
    entries = kinds.where((F.col("spans") > 1) | (F.col("heads") > 1)).join(profiles, ["side", "nconst"])
    entries = materialise(entries.drop("nconst"), "profile_entries")

    # The two largest credit counts per crowd; the number of distinct counts grows with the root of the edges.
    counts = profiles.groupBy("side", "tconst", "m").agg(F.count(F.lit(1)).alias("heads"))
    if same:
        by_count = Window.partitionBy("tconst").orderBy(F.desc("m"))
        top = counts.withColumns({"next": F.lead("m").over(by_count), "place": F.row_number().over(by_count)})
        second = F.when(F.col("heads") > 1, F.col("m")).otherwise(F.col("next"))
        floor = top.where(F.col("place") == 1).select("tconst", (F.col("m") * second).alias("floor"))
        floor = floor.unionByName(entries.where(F.col("heads") > 1).select("tconst", F.col("norm").alias("floor")))
    else:
        side = [counts.where(F.col("side") == s).groupBy("tconst").agg(F.max("m").alias(f"m{s}")) for s in (0, 1)]
        floor = side[0].join(side[1], "tconst").select("tconst", (F.col("m0") * F.col("m1")).alias("floor"))
    floor = floor.where(F.col("floor").isNotNull()).groupBy("tconst").agg(F.max("floor").alias("floor"))
    floor = materialise(floor, "crowd_floor")

    # A crowd's size among the compared profiles, and the largest credit count that either side can meet there.
    members = materialise(entries.where(F.col("spans") > 1).select("side", "tconst", "kind", "m"), "members")
    most = [F.max(F.when(F.col("side") == s, F.col("m"))).alias(f"most{s}") for s in (0, 1)]
    crowds = materialise(members.groupBy("tconst").agg(F.count(F.lit(1)).alias("size"), *most), "crowd_sizes")
    return _raise_floor(members, crowds, floor, same).select("tconst", F.col("floor").alias(name))


def _raise_floor(members: DataFrame, crowds: DataFrame, floor: DataFrame, same: bool) -> DataFrame:
    """(tconst, floor): the floors raised to the largest weight of a pair of profiles that shares the crowd.

    A profile's crowds are ordered from rare to common.  Profiles are put into the bucket of every crowd of theirs (their
    *head*) with the crowds behind it (their *tail*); a pair's whole weight is seen in the bucket of its first common crowd.
    A bucket is either compared, all pairs of it in tiles, or refined: each profile goes on to the heads made longer by one
    crowd of its tail, and the pairs that share the head alone are settled by the distinct credit counts over the head.
    Buckets of more than a tile are refined where that is cheaper, counted beforehand, with ``FEW_PAIRS`` pairs of a tile for a
    row.  Profiles that even with the largest counts of the others cannot beat the floors of their crowds are left out (the
    prefix filter), with floors that rise from round to round.
    """
    n = [F.count_if(F.col("side") == s) for s in (0, 1)]
    pairs = F.floor(n[0] * (n[0] - 1) / 2) if same else n[0] * n[1]
    heads = None
    while True:
        bounded = _bounded(members, crowds, floor, same)
        rows = materialise(_first(bounded) if heads is None else _able(heads.join(_profiles(bounded), ["side", "kind"])), "crowd_buckets")
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), n[0].alias("n0"), n[1].alias("n1"), pairs.cast("long").alias("pairs"))
        plan = materialise(sizes.where(F.col("pairs") > 0).withColumn("refine", F.lit(False)), "crowd_plan")
        left = plan.agg(F.sum("pairs").alias("pairs"), F.sum("n").alias("n")).first()
        if (left["pairs"] or 0) > FEW_PAIRS * (left["n"] or 0):
            large = materialise(plan.where(F.col("pairs") > TASK_PAIRS).select("bucket", "n"), "crowd_large")
            tails = lookup_join(rows, large, ["bucket"], weight="n", how="inner").select("bucket", "side", F.explode("tails").alias("next"))
            further = tails.groupBy("bucket", "next").agg((F.count(F.lit(1)) * max(FEW_PAIRS, 1) + pairs).alias("cost"))
            further = further.groupBy("bucket").agg(F.sum("cost").alias("cost"))
            plan = plan.join(further, "bucket", "left").withColumn("refine", F.coalesce(F.col("cost") < F.col("pairs"), F.lit(False)))
            plan = materialise(plan.drop("cost"), "crowd_plan")
        last = not plan.where("refine").limit(1).count()
        marked = lookup_join(rows, plan, ["bucket"], weight="n", how="inner")
        tasks = math.ceil((left["pairs"] or 0) / max(TASK_PAIRS, 1)) + 1
        found = _compared(marked if last else marked.where(~F.col("refine")), same, tasks)
        if not last:
            refined = materialise(marked.where("refine").drop("n", "n0", "n1", "pairs", "refine"), "crowd_refined")
            found = found.unionByName(_settled(refined, same))
        floor = materialise(floor.unionByName(found).groupBy("tconst").agg(F.max("floor").alias("floor")), "crowd_floor")
        if last:
            return floor
        behind = F.sequence(F.element_at("at", -1) + 1, F.element_at("at", -1) + F.size("tails"))
        longer = refined.where(F.size("tails") > 0).select("side", "kind", "at", F.explode(behind).alias("next"))
        heads = longer.select("side", "kind", F.concat("at", F.array("next")).alias("at"))


def _bounded(members: DataFrame, crowds: DataFrame, floor: DataFrame, same: bool) -> DataFrame:
    """(side, kind, size, tconst, m, gain, floor): entries with the most that a pair can gain in the crowd, and its floor."""
    rival = F.col("most0") if same else F.when(F.col("side") == 0, F.col("most1")).otherwise(F.col("most0"))
    table = materialise(crowds.join(floor, "tconst"), "crowd_bounds")
    bounded = lookup_join(members, table, ["tconst"], weight="size", how="inner").where(rival.isNotNull())
    return bounded.select("side", "kind", "size", "tconst", "m", (F.col("m") * rival).alias("gain"), "floor")


def _first(bounded: DataFrame) -> DataFrame:
    """The rows of ``_able`` for heads of one crowd: the tail and its bounds are what follows it in its profile."""
    ordered = Window.partitionBy("side", "kind").orderBy("size", "tconst")
    rest, behind = [ordered.rowsBetween(first, Window.unboundedFollowing) for first in (0, 1)]
    rows = bounded.select(
        F.array("tconst").alias("bucket"), "side", "kind", F.array(F.row_number().over(ordered) - 1).alias("at"), F.array("m").alias("counts"),
        F.collect_list("tconst").over(behind).alias("tails"), F.collect_list("m").over(behind).alias("tail_counts"),
        F.sum("gain").over(rest).alias("gain"), F.min("floor").over(rest).alias("floor"),
    )
    # What a single crowd gives is in the floors already: the first common crowd needs another behind it.
    return rows.where((F.size("tails") > 0) & (F.col("gain") > F.col("floor"))).drop("gain", "floor")


def _profiles(bounded: DataFrame) -> DataFrame:
    """(side, kind, entries): crowds from rare to common with credits, most that a pair can gain there, and floor."""
    entry = F.struct("size", "tconst", "m", "gain", "floor")
    return bounded.groupBy("side", "kind").agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def _able(placed: DataFrame) -> DataFrame:
    """(bucket, side, kind, at, counts, tails, tail_counts) of the placed profiles that may still beat a floor of theirs.

    A bucket is named by the titles of its head.
    """
    head = F.transform("at", lambda i: F.element_at("entries", i + 1))
    rows = placed.withColumns({"head": head, "tail": F.slice("entries", F.element_at("at", -1) + 2, F.size("entries"))})
    whole = F.concat("head", "tail")
    gain = F.aggregate(F.transform(whole, lambda e: e["gain"]), F.lit(0).cast("long"), lambda s, g: s + g)
    floor = F.array_min(F.transform(whole, lambda e: e["floor"]))
    return rows.where(gain > floor).select(
        F.col("head.tconst").alias("bucket"), "side", "kind", "at", F.col("head.m").alias("counts"),
        F.col("tail.tconst").alias("tails"), F.col("tail.m").alias("tail_counts"),
    )


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, v: s + v)


def _compared(rows: DataFrame, same: bool, tasks: int) -> DataFrame:
    """(tconst, floor) from all pairs of a bucket: their credits over the head and the common crowds of the tails.

    Both sides of a bucket are cut into parts of about the root of ``TASK_PAIRS``, and every two parts are a tile.  With one
    side, a part meets itself and the parts behind it.
    """
    width = F.lit(max(math.isqrt(TASK_PAIRS), 1))
    parts = [F.ceil(F.greatest(F.col(c), F.lit(1)) / width).cast("int") for c in ("n0", "n0" if same else "n1")]
    part = [F.pmod(F.xxhash64("kind"), n).cast("int") for n in parts]
    others = F.sequence(F.lit(0), F.when(F.col("side") == 0, parts[1]).otherwise(parts[0]) - 1)
    own, other = F.when(F.col("side") == 0, part[0]).otherwise(part[1]), F.col("other")
    dealt = rows.withColumns({"own": own, "other": F.explode(others)})
    if same:
        role = F.when(F.col("own") == other, F.lit(2)).otherwise((F.col("own") > other).cast("int"))
        i, j = F.least("own", other), F.greatest("own", other)
    else:
        role, i, j = F.col("side"), F.when(F.col("side") == 0, F.col("own")).otherwise(other), F.when(F.col("side") == 0, other).otherwise(F.col("own"))
    keys = [F.col("bucket"), i.alias("i"), j.alias("j")]
    dealt = dealt.select(*keys, role.cast("int").alias("role"), "counts", "tails", "tail_counts")
    kind = rows.schema["bucket"].dataType.elementType.simpleString()
    tiles = dealt.repartition(min(tasks, MOST_TASKS), "bucket", "i", "j").groupBy("bucket", "i", "j")
    return tiles.applyInArrow(_tile, f"tconst {kind}, floor long").groupBy("tconst").agg(F.max("floor").alias("floor"))


def _tile(table: pa.Table) -> pa.Table:
    """(tconst, floor) of one tile: rows of role 0 meet those of role 1, rows of role 2 each other.

    A sparse product: the weights of the pairs are one array, to which the entries of each common crowd add theirs.
    """
    role = table["role"].to_numpy()
    same = bool((role == 2).any())
    places = [np.flatnonzero(role != 1), np.flatnonzero(role != 0)]
    heads = table["bucket"].combine_chunks().flatten()[: len(table["bucket"][0])]
    nothing = pa.table({"tconst": heads[:0], "floor": pa.array([], pa.int64())})
    if not len(places[0]) or not len(places[1]):
        return nothing
    counts = table["counts"].combine_chunks().flatten().to_numpy().reshape(len(role), len(heads))
    width = len(places[1])

    # Entries of both sides in the order of their crowds, numbered within the tile.
    tails = table["tails"].combine_chunks()
    named = tails.flatten().dictionary_encode()
    crowd, m = named.indices.to_numpy(), table["tail_counts"].combine_chunks().flatten().to_numpy()
    row = np.repeat(np.arange(len(role)), pc.list_value_length(tails).to_numpy())
    sides = []
    for at in places:
        place = np.full(len(role), -1)
        place[at] = np.arange(len(at))
        mine = np.flatnonzero(place[row] >= 0)
        mine = mine[np.argsort(crowd[mine], kind="stable")]
        sides.append((crowd[mine], place[row[mine]], m[mine]))
    (ca, ra, ma), (cb, rb, mb) = sides
    start = np.searchsorted(cb, np.arange(len(named.dictionary) + 1))
    meets = start[ca + 1] - start[ca]
    ends = np.cumsum(meets)
    cuts = np.unique(np.searchsorted(ends, np.arange(BLOCK, (ends[-1] if len(ends) else 0) + BLOCK, BLOCK)) + 1)

    def blocks():
        first = 0
        for cut in cuts:
            n = meets[first:cut]
            a = np.repeat(np.arange(first, min(cut, len(meets))), n)
            b = start[ca[a]] + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            if same:
                ahead = ra[a] < rb[b]
                a, b = a[ahead], b[ahead]
            yield ca[a], ra[a] * width + rb[b], ma[a] * mb[b]
            first = cut

    listed = list(blocks()) if len(cuts) < 4 else None
    if listed is not None and len(heads) == 1 and len(listed) < 2:
        # Few pairs meet in a second crowd: only these have a place.
        if not listed or not len(listed[0][1]):
            return nothing
        met, cell = np.unique(listed[0][1], return_inverse=True)
        listed = [(listed[0][0], cell, listed[0][2])]
        flat = counts[places[0], 0][met // width] * counts[places[1], 0][met % width]
    else:
        weight = sum(np.multiply.outer(counts[places[0], k], counts[places[1], k]) for k in range(len(heads)))
        flat = (np.triu(weight, 1) if same else weight).reshape(-1)
    for _, cell, credits in listed or blocks():
        np.add.at(flat, cell, credits)
    best = np.zeros(len(named.dictionary), np.int64)
    for of, cell, _ in listed or blocks():
        if len(of):
            found = np.flatnonzero(np.diff(of, prepend=-1))
            best[of[found]] = np.maximum(best[of[found]], np.maximum.reduceat(flat[cell], found))
    top = int(flat.max()) if len(heads) > 1 else int(best.max(initial=0))
    if not top:
        return nothing
    raised = np.flatnonzero(best)
    floors = np.concatenate([np.full(len(heads), top), best[raised]])
    return pa.table({"tconst": pa.concat_arrays([heads, named.dictionary.take(pa.array(raised))]), "floor": pa.array(floors, pa.int64())})


def _settled(rows: DataFrame, same: bool) -> DataFrame:
    """(tconst, floor) from the credits over the heads alone: pairs of distinct counts, not of profiles."""
    longer = rows.where(F.size("bucket") > 1)
    kinds = longer.groupBy("bucket", "side", F.col("counts").alias("ms")).agg(F.count(F.lit(1)).alias("kinds"))
    a = kinds.where(F.col("side") == 0).select("bucket", "kinds", F.col("ms").alias("ma"))
    b = kinds.where(F.col("side") == (0 if same else 1)).select("bucket", F.col("ms").alias("mb"))
    both = a.join(b, "bucket")
    if same:
        both = both.where((F.col("ma") < F.col("mb")) | ((F.col("ma") == F.col("mb")) & (F.col("kinds") > 1)))
    best = both.select("bucket", _dot("ma", "mb").alias("floor"))
    return best.select(F.explode("bucket").alias("tconst"), "floor").groupBy("tconst").agg(F.max("floor").alias("floor"))


def feature_matrix(titles: DataFrame, directors: DataFrame | None = None, writers: DataFrame | None = None) -> DataFrame:
    """Titles with every crew feature that the given relations allow; titles without crew keep nulls."""
    features = []
    if directors is not None:
        features.append(degree_features(directors, "director"))
    if writers is not None:
        features += [degree_features(writers, "writer"), same_role_weight(writers, "writer")]
    if directors is not None and writers is not None:
        features.append(cross_role_weight(writers, directors, "writer", "director"))
    if not features:
        return titles
    # Brought together first, a row per title and table, so the titles are joined once: to a broadcast table, or in a shuffled
    # join of two scans, whose partitions of null and hot keys adaptive execution splits.
    cells = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), features)
    crew = cells.groupBy("tconst").agg(*[F.max(c).alias(c) for c in cells.columns if c != "tconst"])
    return lookup_join(titles, materialise(crew, "crew"), ["tconst"])
