"""The corpus pipeline: language ID, near-duplicate removal, PII, mixing and piece encoding, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder and reads it
again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import jaccard_join, language_id, mixing, pieces, pii
from pluvio.llm.common import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.1  # cosine with the nearest language: three times the noise of DIMENSIONS, 1 / sqrt(1024), which is what no resemblance comes to
# One trigram of n different ones turns a text by 1 / sqrt(n): with fewer than these, a clean text that misses the common trigrams can lie below LEAST_SCORE
LEAST_TRIGRAMS = round(1 / LEAST_SCORE**2)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows and drops what has no letter, or has LEAST_TRIGRAMS and resembles no language; ``lang`` is filled in where it is null."""
    docs = docs.select(*COLUMNS)
    model = language_id.train(docs, F.lit(False))
    told = language_id.predict(docs, model, *COLUMNS, evidence=True)
    kept = told.where((F.col("lang_pred") != language_id.UNKNOWN) & ((F.col("score") >= LEAST_SCORE) | (F.col("n_trigrams") < LEAST_TRIGRAMS)))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram Jaccard join, the document with the smallest id stays.

    A null id counts as one above all others that follows from the text. Rows with one id are one document: it goes if its component
    has a smaller id; else, of its rows that link with something, the first by digest stays. Only ids are shuffled unless the dropped ones are too many to send."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61)))
    rows = docs.select(number.alias("row_id"), F.struct(*COLUMNS).alias("row"), "text")
    joined = jaccard_join.join(rows.select(F.col("row_id").alias("doc_id"), "text"))
    gone = materialize(joined.where("component_id <> doc_id").select(F.col("doc_id").alias("row_id")).distinct(), "duplicates")
    again = materialize(joined.where("n_links > 0").groupBy(F.col("doc_id").alias("row_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated_ids")
    kept = rows.join(gone, "row_id", "left_anti")
    if not again.limit(1).count():
        return kept.select("row.*")
    first = kept.join(again, "row_id", "left_semi").groupBy("row_id").agg(F.min_by("row", F.sha2(F.coalesce("text", F.lit("")), 256)).alias("row"))
    return kept.join(again, "row_id", "left_anti").select("row.*").unionByName(first.select("row.*"))


def sanitize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities and disclosing terms of each text are replaced and n_chars follows; every row stays, null texts too, whatever its id and however often it comes."""
    return pii.sanitize(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; one that it does not take goes.

    Rows of one id, text and source are taken as often as the mix takes them together; where their lang or n_chars differ, the first of
    them stands for all. Null text is never taken. An empty table gives an empty one."""
    docs = docs.select(*COLUMNS)
    taken = mixing.mixed_lanes(docs).where("copies > 0").select("doc_id", "lane", "copies", "repeats")
    keyed = docs.withColumn("lane", mixing.lane_of())
    joined = keyed.alias("d").join(taken.alias("t"), (F.col("d.lane") == F.col("t.lane")) & F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")))
    joined = joined.select(*(F.col(f"d.{c}").alias(c) for c in COLUMNS), F.col("d.lane").alias("lane"), "copies", "repeats")
    again = joined.where("repeats > 1").groupBy("doc_id", "lane", "copies").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*", "copies")
    rows = joined.where("repeats = 1").select(*COLUMNS, "copies").unionByName(again)
    return rows.select(*COLUMNS, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, digests and the ids of every document that the mix holds, a row a copy. Null and empty texts have no pieces."""
    return pieces.encode_documents(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("pii", sanitize),
    ("mixing", mix_sources),
    ("pieces", encode),
]

ORACLE_SQL = None  # language vectors, PMI and merges have no SQL; tests hold each stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
