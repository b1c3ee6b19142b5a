"""A training-data pipeline over ``documents``: each stage's rows are written as Parquet and reread by the next.

Every stage reads doc_id, text, lang, source and n_chars and passes other columns on where it keeps rows.  Null ids, texts,
languages and sources, empty texts, repeated rows and empty tables are allowed; what becomes of them is told by each stage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footlight.llm import languages, minhash, mixing, pieces, recompression
from footlight.operators.ordering import sorted_positions
from footlight.operators.skew import lookup_join
from footlight.session import materialise

# Weights 3, 1 and 2 in turn by source: falling, rising and even over the run.
SCHEDULES = [[(0.0, 4.5), (1.0, 1.5)], [(0.0, 0.5), (0.5, 0.75), (1.0, 2.0)], [(0.0, 2.0), (1.0, 2.0)]]

# Logarithm by which a letter may be less likely in the taught languages than among even trigrams: texts of taught languages, down
# to single words, lie 5 above on average, random letters and untaught languages 2 to 8 below.
STRANGE = 1.0


def _own(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text stays unless the taught languages explain it worse, by more than ``STRANGE`` per letter, than even trigrams do.

    Null texts, texts without a letter, random letters and languages that no labelled document teaches go.  Where no document has
    a language, nothing is taught, and every text with a letter stays.
    """
    model = languages.fit(docs, "doc_id", "text", "lang")
    if not model[0]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rest = [c for c in docs.columns if c != "text"]  # packed: identify adds columns that the table may have
    packed = docs.select("text", F.col("text").alias("_whole"), F.struct(F.lit(0).alias("_"), *rest).alias("_rest"))
    judged = languages.identify(packed, model, ["_whole", "_rest"]).where(F.col("fit") >= -STRANGE)
    return judged.select(*[F.col("_whole").alias(c) if c == "text" else F.col("_rest")[c].alias(c) for c in docs.columns])


# Bits of a row's number that tell its place in its file; the others tell the file.
PLACE_BITS = 36


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column that numbers each row: its file and place in it, or a number written beside it.

    A row keeps its number whenever the files are read again, so no copy of the documents is written.
    """
    row, path, place = _own(docs, "_row"), _own(docs, "_path"), _own(docs, "_place")
    try:
        at = docs.withColumns({path: F.col("_metadata.file_path"), place: F.col("_metadata.row_index")})
    except AnalysisException:  # not read from files
        return materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row
    code = _own(docs, "code")
    files = sorted_positions(at.select(path).distinct(), path).withColumnRenamed("code", code)
    numbered = lookup_join(at, materialise(files, "files"), [path])
    number = F.shiftleft(F.col(code).cast("long"), PLACE_BITS) + F.col(place)
    return numbered.select(*docs.columns, number.alias(row)), row


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, the one with the smallest id; rows without an id come last.

    Rows are judged, not ids: each is a document of its own, also where it shares its id with others or has none.
    """
    numbered, row = _keyed(docs)
    found = minhash.near_duplicates(numbered.select(row, "text"), id_column=row).select(row, "component_id")
    named = numbered.select(row, "doc_id").join(found, row)
    named = materialise(named, "components_of_rows")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    groups = named.groupBy("component_id").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    groups = materialise(groups.select("component_id", "_n", F.col("_first")[row].alias("_kept")), "groups")
    gone = lookup_join(named, groups, ["component_id"], weight="_n", how="inner").where(F.col(row) != F.col("_kept")).select(row)
    return lookup_join(numbered, materialise(gone, "copies"), [row], how="left_anti").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that repeat are cut; a document of which no word is left goes."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    packed = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *rest).alias("_rest"))
    cut = recompression.remove_repeats(packed, keep=["_rest"])
    left = cut.where((F.col("n_removed") < F.col("n_words")) | (F.col("n_words") == 0))
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept").alias("text"), "n_chars": F.char_length("kept").cast("long").alias("n_chars")}
    return left.select(*[made[c] if c in made else F.col("_rest")[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes at least half of them, in the order of training; the others go.

    Rows are taken, not ids: rows that share id and text are each taken as often as their own place in the mix says.
    """
    keyed, row = _keyed(docs)
    mixed = mixing.mix(keyed, SCHEDULES, keep=[row])
    taken = F.filter("passes", lambda p: 2 * p["words"] >= F.col("size"))
    passes, at = _own(docs, "_passes"), _own(docs, "_pass")
    times = mixed.select(row, taken.alias(passes)).where(F.size(passes) > 0)
    each = keyed.join(times, row).select(*docs.columns, F.explode(passes).alias(at))
    return each.orderBy(f"{at}.position", "doc_id").select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text again."""
    ids = pieces.encode(docs, ["doc_id", "lang", "source"], check=True)
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]

# SQL has no fingerprint search, mixture inference or SentencePiece: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
