"""Mixing sources to target weights that vary over training: a curriculum.

* **Targets.**  A source's weight is the integral of its schedule.  The words wanted are dealt to the sources by weight; a
  source gives at most ``most`` times its own words, and what it cannot give is dealt to the others by weight again.
* **Passes.**  A source's documents have an order of their own (a digest of the id), which lays them out on a line as long
  as the source; the target cuts that line, repeated for every further pass.  So a source is taken to the word, no
  document is taken more than ``most`` times, and equal runs take the same.
* **Positions.**  The schedule's integral says how much of its target a source has been asked for up to a point of
  training.  The inverse of that, at the place where a document begins, is the document's position; sorting by it (a range
  sort) interleaves the sources as the schedules want at every moment.

A source is cut into about as many buckets by digest as the root of its number of rows, so running sums need one small
total per bucket, and neither a hot source nor the list of buckets is ever long in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footlight.operators.skew import lookup_join
from footlight.session import materialise

WORD = r"[^\x20\x09-\x0D]+"

# Each schedule is a list of (time, weight) from time 0 to time 1, straight in between.
Schedule = Sequence[tuple[float, float]]


def _segments(schedule: Schedule) -> list[tuple[float, float, float, float]]:
    """(time, weight, slope, integral before) per stretch of a schedule, and the total as the integral of a last one."""
    times = [t for t, _ in schedule]
    if times[0] != 0 or times[-1] != 1 or sorted(times) != times or len(set(times)) != len(times):
        raise ValueError("times run from 0 to 1")
    if min(w for _, w in schedule) < 0 or max(w for _, w in schedule) <= 0:
        raise ValueError("weights are not negative, and not all zero")
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        out.append((t0, w0, (w1 - w0) / (t1 - t0), before))
        before += (w0 + w1) / 2 * (t1 - t0)
    return [*out, (1.0, 0.0, 0.0, before)]


def _literal(schedules: Sequence[Schedule]) -> Column:
    rows = [
        F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in zip(("t", "w", "slope", "before"), s)]) for s in _segments(x)])
        for x in schedules
    ]
    return F.array(*rows)


def _position(done: Column, segments: Column) -> Column:
    """Time at which the share ``done`` of a schedule's integral has been asked for."""
    wanted = done * F.element_at(segments, -1)["before"]
    reached = F.filter(F.slice(segments, 1, F.size(segments) - 1), lambda s: s["before"] <= wanted)
    s = F.element_at(reached, -1)
    more = wanted - s["before"]
    root = F.sqrt(F.greatest(s["w"] * s["w"] + F.lit(2.0) * s["slope"] * more, F.lit(0.0)))
    return s["t"] + F.when(more > 0, F.lit(2.0) * more / (s["w"] + root)).otherwise(0.0)


def targets(sources: DataFrame, schedules: Sequence[Schedule], share: tuple[int, int], most: int) -> DataFrame:
    """Adds ``rank``, ``weight``, ``target`` (double) to (key, source, words), one row per source.

    Sources take the schedules in turn, by code point, null last.  ``share`` times all words are dealt by weight.  A source
    is full when its weight's part exceeds ``most`` times its words: sources sorted by how early that happens are filled in
    turn until the part of the next one fits, which is where repeated dealing ends as well.
    """
    weights = F.array(*[F.lit(_segments(s)[-1][3]) for s in schedules])
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.get(weights, F.pmod(F.col("rank"), F.lit(len(schedules)))))
    limit = F.lit(most) * F.col("words")
    early = Window.orderBy(limit / F.col("weight"), "rank")
    wanted = F.sum("words").over(Window.partitionBy()) * F.lit(share[0]) / F.lit(float(share[1]))
    full_before = F.coalesce(F.sum(limit).over(early.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(early.rowsBetween(0, Window.unboundedFollowing))
    each = ranked.withColumn("each", (wanted - full_before) / open_weight)
    fits = F.col("each") * F.col("weight") <= limit
    last = F.min(F.when(fits, F.struct(limit / F.col("weight"), F.col("rank"), F.col("each")))).over(Window.partitionBy())
    dealt = F.least(limit.cast("double"), last["each"] * F.col("weight"))
    return each.withColumn("target", F.coalesce(dealt, limit.cast("double"))).drop("each")


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule],
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(<id>, digest, source, size, source_size, target, taken, passes, <keep>): one row per row of ``docs``.

    ``size`` counts the words of the whole text (null: 0); ``taken`` the words that the mix takes, repeats counted;
    ``passes`` lists (position, words) of each time that a document is taken, ``words`` falling short of ``size`` only where
    a target ends inside it.  A null source is a source like any other.  Rows that repeat an id are placed one after the
    other, rows without an id by their text.  ``digest`` names the row's text, to tell such rows apart.
    """
    size = F.coalesce(F.regexp_count(F.col(text_column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    source = F.col(source_column).cast("string")
    nameless = F.concat(F.lit("text "), F.xxhash64(F.col(text_column).cast("string")).cast("string"))
    rows = docs.select(
        F.col(id_column).alias("id"),
        source.alias("source"),
        size.alias("size"),
        F.xxhash64(F.col(text_column).cast("string")).alias("digest"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key"),
        F.md5(F.coalesce(F.col(id_column).cast("string"), nameless).cast("binary")).alias("place"),
        F.struct(F.lit(0).alias("_"), *keep).alias("rest"),
    )
    rows = materialise(rows, "sized")
    sources = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    dealt = targets(sources, schedules, share, most).drop("source", "weight")
    dealt = materialise(dealt.withColumn("buckets", F.ceil(F.sqrt("n"))), "targets")
    rows = lookup_join(rows, dealt, ["key"], weight="n")
    part = F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    rows = materialise(rows.withColumn("bucket", F.floor(part * F.col("buckets"))), "bucketed")
    sums = rows.groupBy("key", "bucket").agg(F.sum("size").alias("all"), F.count(F.lit(1)).alias("m"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialise(sums.withColumn("before", F.coalesce(F.sum("all").over(earlier), F.lit(0))).drop("all"), "bucket_sums")
    rows = lookup_join(rows, sums, ["key", "bucket"], weight="m")
    inside = Window.partitionBy("key", "bucket").orderBy("place", "id", "size", "digest").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.col("before") + F.sum("size").over(inside) - F.col("size"))

    quota = F.round("target").cast("long")
    segments = F.get(_literal(schedules), F.pmod(F.col("rank"), F.lit(len(schedules))))
    passes = []
    for i in range(most):
        begin = F.col("start") + F.lit(i) * F.col("words")
        n = F.greatest(F.least(F.col("size"), quota - begin), F.lit(0))
        passes.append(F.struct(_position(F.least(begin / F.greatest(quota, F.lit(1)), F.lit(1.0)), segments).alias("position"), n.alias("words")))
    rows = rows.withColumn("passes", F.filter(F.array(*passes), lambda p: p["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    return rows.select(
        F.col("id").alias(id_column), "digest", "source", "size", F.col("words").alias("source_size"), "target", taken.alias("taken"), "passes",
        *[F.col("rest").getField(c).alias(c) for c in keep],
    )


def training_order(mixed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(<id>, digest, pass, position, words), range-sorted by position: the documents in the order of training."""
    each = mixed.select(id_column, "digest", F.posexplode("passes").alias("pass", "p"))
    return each.select(id_column, "digest", "pass", "p.position", "p.words").orderBy("position", "digest", id_column, "pass")
