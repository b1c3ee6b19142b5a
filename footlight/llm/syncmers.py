"""Document fingerprints by closed syncmers, in DataFrame expressions only.

A text is a row of *units*: its words, cut from their beginning into pieces of at most ``PIECE`` code points.  A *k-mer* is ``K``
consecutive units, its inner strings are the runs of ``S`` units in it.  A k-mer is an anchor when the lowest hash among its inner
strings stands at either edge.  That depends on its own units alone, not on what surrounds them, so equal passages give
equal anchors wherever they are, and every stretch of K - S + 1 k-mers has one.

A fingerprint lists position and hash of each anchor in text order (``position:hash``, joined by blanks).  Likeness is taken from the
fingerprints themselves.

Two texts have an anchor in common for sure if they share a stretch of 2 K - S units, about five words.  Texts without blanks have
units as well: copies share them as far as they begin alike, or behind the next blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footlight.operators.ordering import cut_points, with_buckets
from footlight.session import materialise

K, S, PIECE = 5, 2, 4
# Buckets of rows without an id, by their texts.
NAMELESS = 1024


def units(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0))


def anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds array ``name`` of (position, hash) structs, the anchors of column ``text`` in order.

    Texts with fewer than K units have one anchor, the whole sequence; null and blank texts have none.
    """
    return anchors_of(df, units(F.col(text)), name, K, S)


def anchors_of(df: DataFrame, units: Column, name: str, k: int, s: int) -> DataFrame:
    """Adds array ``name`` of (position, hash) structs, the anchors of an array of strings in order; none of a null array."""
    out = df.withColumn("_h", F.transform(F.coalesce(units, F.array().cast("array<string>")), lambda w: F.xxhash64(w)))
    later = F.slice("_h", F.lit(s), F.greatest(F.size("_h"), F.lit(1)))
    # Zipping runs on to the longer array: the last S - 1 elements are no inner strings, and no k-mer reaches them.
    out = out.withColumn("_e", F.zip_with("_h", later, lambda x, y: F.xxhash64(x, y)))
    span = k - s + 1  # inner strings of a k-mer
    edge = lambda i: F.least(F.get("_e", i), F.get("_e", i + F.lit(span - 1)))
    at = F.filter(
        F.sequence(F.lit(0), F.size("_h") - F.lit(k)), lambda i: edge(i) == F.array_min(F.slice("_e", i + F.lit(1), F.lit(span)))
    )
    kmers = F.transform(
        at, lambda i: F.struct(i.alias("position"), F.xxhash64(F.slice("_h", i + F.lit(1), F.lit(k))).alias("hash"))
    )
    whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64("_h").alias("hash")))
    none = F.array().cast("array<struct<position:int,hash:bigint>>")
    found = F.when(F.size("_h") >= k, kmers).when(F.size("_h") > 0, whole).otherwise(none)
    return out.withColumn(name, found).drop("_h", "_e")


def fingerprint(found: Column) -> Column:
    """Anchors as text: equal texts have equal fingerprints; no anchors give an empty one."""
    one = lambda a: F.concat(a["position"].cast("string"), F.lit(":"), F.hex(a["hash"]))
    return F.array_join(F.transform(found, one), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of different anchor hashes that both have, of the larger side's: 0 to 1; 1 when neither has any."""
    x, y = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    n = F.greatest(F.size(x), F.size(y))
    return F.when(n == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / n)


def with_next(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text, next_text, and what ``_next_row`` needs): each row with the text of the next one by descending id.

    The last is followed by the first.  Rows go to buckets of ids; each bucket also gets the first row of the bucket that
    follows, so the order inside the buckets is enough.  Null ids come last; equal ids, and null ones, are ordered by a hash of the
    text, which deals the null ones to ``NAMELESS`` buckets.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.xxhash64(F.col(text_column).cast("string")).alias("tk")
    )
    cuts = cut_points(rows.where(F.col("id").isNotNull()), ["id"])
    bucketed = with_buckets(rows, cuts).withColumnRenamed("_b_id", "bucket")
    share = (F.lit(2.0**63) - F.col("tk").cast("double")) / F.lit(2.0**64)
    nameless = -1 - F.least(F.floor(share * F.lit(NAMELESS)), F.lit(NAMELESS - 1)).cast("int")
    bucketed = bucketed.withColumn("bucket", F.when(F.col("id").isNull(), nameless).otherwise(F.col("bucket")))
    place = F.struct(F.coalesce(F.col("id").cast("double"), F.lit(float("-inf"))), F.coalesce(F.col("id"), F.lit(0)), "tk")
    heads = bucketed.groupBy("bucket").agg(F.max_by(F.struct("id", "text", "tk"), place).alias("head"))
    heads = materialise(heads, "heads")  # a row per bucket
    following = Window.orderBy(F.desc("bucket"))
    first = F.max(F.struct("bucket", "head")).over(Window.partitionBy())["head"]
    heads = heads.withColumn("head", F.coalesce(F.lead("head").over(following), first))
    rows = bucketed.select("bucket", "id", "text", "tk", F.lit(False).alias("_next_row"))
    return rows.unionByName(heads.select("bucket", "head.id", "head.text", "head.tk", F.lit(True).alias("_next_row")))


def compare_neighbours(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they and the next document's are.

    (<id>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row per row.  The edited text
    has its second half, rounded down, replaced by as many code points from the start of the next document (or all).
    """
    rows = with_next(docs, id_column, text_column)
    order = Window.partitionBy("bucket").orderBy("_next_row", F.desc_nulls_last("id"), F.desc_nulls_last("tk"))
    rows = rows.withColumn("next_text", F.lead("text").over(order))
    text, other = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half)))
    rows = anchors(rows, "text", "own")
    rows = rows.withColumn("next_own", F.lead("own").over(order)).where(~F.col("_next_row"))
    rows = anchors(rows, "edited", "edited_own")
    return rows.select(
        F.col("id").alias(id_column),
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
