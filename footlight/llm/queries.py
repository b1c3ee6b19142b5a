"""Registered queries of the operators, with production parameters over whole tables, and SQL twins where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlight.llm import binarycodes, hosts, languages, leaks, minhash, mixing, pieces, recompression, repair, sharding, syncmers, trie, warc
from footlight.plans.registry import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name; ``sql`` is the twin to compare it with."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return add


@query()
def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links at 0.85 over three-word shingles: twin is quadratic in SQL, so tests compare with brute force."""
    return minhash.near_duplicates(table(spark, folder, "documents"), words=3, share=(85, 100), bands=26, rows=6)


@query()
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of 35 words that start anywhere else are removed; tests compare with all windows listed."""
    cut = recompression.remove_repeats(table(spark, folder, "documents"), window=35)
    words = F.trim(F.regexp_replace("kept", r"[\x20\x09-\x0D]+", " "))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce(words, F.lit("")), 256).alias("kept_sha256"))


@query()
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every whole text, and whether decoding them gives the text again; tests compare with the library."""
    ids = pieces.encode(table(spark, folder, "documents"), ["doc_id"], check=True)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


@query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions for all documents by a model of the documents that are not held out; tests measure accuracy."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    marked = documents.withColumn("held_out", held_out)
    model = languages.fit(marked.where(~F.col("held_out") & F.col("doc_id").isNotNull()), "doc_id", "text", "lang")
    return languages.identify(marked, model, ["doc_id", "held_out"])


# Weights 3, 1 and 2 over the whole run: falling, rising and even.
_SCHEDULES = [[(0.0, 4.5), (1.0, 1.5)], [(0.0, 0.5), (0.5, 0.75), (1.0, 2.0)], [(0.0, 2.0), (1.0, 2.0)]]


@query(
    r"""
    WITH sized AS (
        SELECT doc_id, source, md5(doc_id::VARCHAR) AS place,
               coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
        FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS words, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
               row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM sized GROUP BY source
    ), e AS (
        SELECT *, 2 * words / weight AS early,
               (sum(words) OVER () * 3 / 2.0::DOUBLE - coalesce(sum(2 * words) OVER (ORDER BY 2 * words / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY 2 * words / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS each_
        FROM s
    ), l AS (
        SELECT each_ FROM e WHERE each_ * weight <= 2 * words ORDER BY early, rank LIMIT 1
    ), t AS (
        SELECT source, words, least((2 * words)::DOUBLE, coalesce((SELECT each_ FROM l) * weight, 2 * words)) AS target FROM e
    ), p AS (
        SELECT doc_id, size, words AS source_size, target, round(target)::BIGINT AS quota,
               sum(size) OVER (PARTITION BY sized.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
        FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
           (greatest(least(size, quota - start), 0) + greatest(least(size, quota - start - source_size), 0))::BIGINT AS taken
    FROM p
    """
)
def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of every document, in order of training: first position, those never taken last."""
    mixed = mixing.mix(table(spark, folder, "documents"), _SCHEDULES)
    first = F.get("passes", F.lit(0))["position"]
    return mixed.orderBy(first.asc_nulls_last(), "doc_id").select("doc_id", "size", "source_size", "target", "taken")


# All columns of op3 but the checksum, which SQL has no function for; tests compare with it.
SHARD_SQL = r"""
    WITH r AS (
        SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, coalesce(md5(text), '') AS key, md5(doc_id::VARCHAR) AS place
        FROM documents
    ), g AS (
        SELECT *, sum(size) OVER (ORDER BY key, place, doc_id ROWS UNBOUNDED PRECEDING) AS end_, sum(size) OVER () AS total,
               row_number() OVER (ORDER BY key, place, doc_id) AS at_
        FROM r
    ), m AS (
        SELECT *, sum(size) OVER (PARTITION BY key) AS group_size, max(end_) OVER (PARTITION BY key) AS group_end FROM g
    ), s AS (
        SELECT *, least((CASE WHEN group_size * 1024 > total THEN 2 * end_ - size ELSE 2 * group_end - group_size END) * 16 // (2 * total), 15)::INTEGER AS shard
        FROM m
    )
    SELECT doc_id, size::BIGINT AS size, shard, (at_ - min(at_) OVER (PARTITION BY shard))::BIGINT AS slot FROM s
    """


@query()
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes."""
    out = sharding.assign_shards(table(spark, folder, "documents"), 16)
    nothing = F.lit(None).cast("int")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", nothing.alias("grown_shard"))


# The rules of the query.
_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query(
    r"""
    WITH p AS (
        SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages
    ), u AS (
        SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM p
    ), l AS (
        SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
        FROM labels WHERE doc_id IS NOT NULL AND (toxic IS NOT NULL OR quality IS NOT NULL) GROUP BY doc_id
    ), c AS (
        SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
               array_to_string(string_split(host, '.')[-1:], '.') AS suffix, array_to_string(string_split(host, '.')[-2:], '.') AS domain
        FROM u LEFT JOIN l ON try_cast(regexp_extract(path, '/([0-9]+)', 1) AS BIGINT) = doc_id GROUP BY host
    ), d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM c GROUP BY ALL
    ), s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) FROM d) AS prior FROM d GROUP BY suffix
    ), s1 AS (SELECT *, 1 / least(greatest(coalesce(sum(n * (pow(bad / n - prior, 2) / (prior * (1 - prior)) - 1 / n)) FILTER (n > 0) OVER ()
                                           / nullif(sum(n - 1) FILTER (n > 0) OVER (), 0), 0.001), 0.001), 0.9) - 1 AS k FROM s0
    ), s AS (SELECT suffix, (k * prior + bad) / (k + n) AS prior FROM s1
    ), d1 AS (SELECT domain, n, bad, prior, 1 / least(greatest(coalesce(sum(n * (pow(bad / n - prior, 2) / (prior * (1 - prior)) - 1 / n)) FILTER (n > 0) OVER ()
                                           / nullif(sum(n - 1) FILTER (n > 0) OVER (), 0), 0.001), 0.001), 0.9) - 1 AS k FROM d JOIN s USING (suffix)
    ), d2 AS (SELECT domain, (k * prior + bad) / (k + n) AS prior FROM d1
    ), h1 AS (SELECT host, n, bad, prior, 1 / least(greatest(coalesce(sum(n * (pow(bad / n - prior, 2) / (prior * (1 - prior)) - 1 / n)) FILTER (n > 0) OVER ()
                                           / nullif(sum(n - 1) FILTER (n > 0) OVER (), 0), 0.001), 0.001), 0.9) - 1 AS k FROM c JOIN d2 USING (domain)
    ), h2 AS (SELECT host, k * prior + bad AS a, k * (1 - prior) + n - bad AS b FROM h1
    ), h AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS low FROM h2
    ), r AS (
        SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS t(verdict, rh, rp)
    ), m AS (
        SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(r.verdict, length(rh || rp)) AS verdict
        FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
    )
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
    FROM u LEFT JOIN m USING (page_id) LEFT JOIN h USING (host)
    """
)
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Rules and host reputation for all pages; a page's outcome is the label of the document it shows."""
    labels = table(spark, folder, "labels")
    known = F.col("toxic").isNotNull() | F.col("quality").isNotNull()
    bad = F.when((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0), 1).otherwise(0)
    outcomes = labels.where(known).select(F.col("doc_id").alias("id"), bad.alias("bad"))
    judged = hosts.judge_pages(table(spark, folder, "pages"), outcomes, _RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op9_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Closed-syncmer fingerprints of all texts and their edited texts; tests compare with a plain version."""
    return syncmers.compare_neighbours(table(spark, folder, "documents"))


@query()
def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links at cosine 0.93 inside labels; tests compare with all cosines."""
    return binarycodes.near_vectors(table(spark, folder, "embeddings"), 0.93)


@query()
def op4_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata and text records of all pages, taken as a crawl's responses; tests compare with a plain version."""
    responses = warc.response_records(table(spark, folder, "pages"), "page_id", "url", "html", "2024-01-01T00:00:00Z")
    return warc.derive(responses, ["page_id"])


@query(
    r"""
    WITH b AS (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), s AS (
        SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS at_ FROM b WHERE len(w) > 0
    ), i AS (
        SELECT DISTINCT item_id, n, array_to_string(list_slice(w, at_, at_ + n - 1), ' ') AS seq FROM s
    ), d AS (
        SELECT row_number() OVER () AS r, doc_id,
               coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
        FROM documents
    ), x AS (
        SELECT r, n, at_, array_to_string(list_slice(w, at_, at_ + n - 1), ' ') AS seq
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS at_ FROM d, (SELECT DISTINCT n FROM i))
    ), f AS (SELECT r, x.n, at_, item_id FROM x JOIN i ON x.n = i.n AND x.seq = i.seq
    ), h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(at_, at_ + n)) FROM f) GROUP BY r
    ), g AS (
        SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM f GROUP BY r
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN h USING (r) LEFT JOIN g USING (r)
    """
)
def op11_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents that lie in windows of ten words of any test item, and the items."""
    found = leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"], window=10)
    return found.select(
        "rest.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(
    r"""
    WITH t AS (
        SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sym) AS pos, sym, size
        FROM (SELECT conv_id, turn, length(coalesce(text, ''))::BIGINT AS size,
                     md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sym
              FROM conversations WHERE conv_id IS NOT NULL)
    ), k AS (
        SELECT c, count(*) AS n,
               xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                   lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, _: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h
        FROM t GROUP BY c
    ), m AS (
        SELECT k.*, least(h, coalesce(b.n, 0)) AS taken FROM k LEFT JOIN (SELECT c AS base, n FROM k) b ON base = c - c % 100
    ), r AS (
        SELECT c, 0::BIGINT AS d, '' AS sym, 0::BIGINT AS size FROM m
        UNION ALL SELECT m.c, t.pos, t.sym, t.size FROM m JOIN t ON t.c = m.c - m.c % 100 AND t.pos <= m.taken
        UNION ALL SELECT m.c, m.taken + t.pos - m.h, t.sym, t.size FROM m JOIN t ON t.c = m.c AND t.pos > m.h
    ), p AS (
        SELECT c, d, size, md5(string_agg(sym, '') OVER w) AS key, max(d) OVER (PARTITION BY c) = d AS ends
        FROM r WINDOW w AS (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)
    ), q AS (SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS up FROM p
    ), n AS (
        SELECT d, key, min(c) AS owner, count(*) AS n, any_value(up) AS up, (count(*) - 1) * any_value(size) AS saved,
               sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
        FROM q GROUP BY d, key
    ), f AS (SELECT n.*, (SELECT count(*) FROM n o WHERE o.up = n.key AND o.d = n.d + 1) AS n_children FROM n
    ), s AS (
        SELECT p.d, p.key, sum(f.saved) AS saved, count(*) FILTER (f.n_children = 0) AS n_leaves
        FROM f JOIN p ON p.c = f.owner AND p.d <= f.d GROUP BY p.d, p.key
    )
    SELECT f.owner AS conv_id, f.d AS depth, a.owner AS parent_conv_id, f.n AS n_convs, f.n_children::BIGINT AS n_children,
           s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, f.ends_sha256
    FROM f JOIN s ON f.d = s.d AND f.key = s.key LEFT JOIN n a ON a.key = f.up AND a.d = f.d - 1
    """
)
def op12_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Trie of all conversations, each rebuilt on the head of the first of its hundred."""
    conversations = table(spark, folder, "conversations")
    return trie.prefix_trie(conversations, lambda c: c - c % 100, lambda c: F.crc32(c.cast("string").cast("binary")) % 6, 5)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows that ``op13`` repairs: by a checksum, some are dropped (not ``present``), emptied, stripped, repeated or given to the user."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    role = F.when(fate == 4, "user").otherwise(shown("role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fate != 0).alias("present"), fate.alias("fate"))
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1)))).drop("fate", "copy")


class _Audit:
    """What one conversation's edits add up to, row by row."""

    def __init__(self, key):
        self.key, self.sums, self.edits = key, dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0), []
        self.low = self.high = self.turn = self.was = None
        self.distinct, self.digest, self.lines = 0, hashlib.sha256(), 0

    def add(self, edit, turn, was, role, text, fault, cost) -> None:
        if edit is None:
            return
        self.edits.append(edit)
        self.sums["cost"] += cost
        if edit != "D":
            self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1
        if edit == "I":
            return
        if fault:
            self.sums[fault] += 1
        self.sums["illegal"] += self.was is not None and self.was[:1] + was[:1] not in ("su", "ua", "au")
        self.was = was
        if turn is not None:  # turns ascend
            self.distinct += turn != self.turn
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.key, gaps, *self.sums.values(), "".join(self.edits), self.digest.hexdigest())


_AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its edits, which come in order."""
    names = [c.split(" ")[0] for c in _AUDIT.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in _AUDIT.split(", ")]
    now = None
    for batch in batches:
        done = []
        for key, n, *rest in zip(*[c.to_pylist() for c in batch.columns]):
            if n <= 1:
                done += [now.row()] if now else []
                now = _Audit(key)
            now.add(*rest)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(now.row(), kinds)], names)


@query()
def op13_conversation_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Audits of all damaged conversations; tests compare with a plain search over all edits."""
    edits = repair.repair(damaged(table(spark, folder, "conversations")), present_column="present")
    return edits.mapInArrow(_audits, _AUDIT)
