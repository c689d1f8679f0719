"""Corpus pipeline over ``documents``: quality, language, near duplicates, benchmark passages, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next
stage's ``docs``.  All but the last return the columns of ``documents``; rows that a stage rejects are gone for the next one.  Labels and the
benchmark are read from ``sf_dir``; models and statistics are fitted on what the stage before kept.

Defined cases: null and empty texts pass the quality stage at the prior, and go in the language stage (no letters); rows with a null id
are judged by their own content and are never merged with others; repeated rows (same id) share their fate; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.llm import decontaminate, language_id, ngram_jaccard, pieces, quality
from tabmill.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


#: Rows of an Arrow batch between Spark and Python: whole texts are large, so the default of 10,000 rows would hold
#: tens of MB in the JVM and in every Python worker.
BATCH_ROWS = "4000"


def batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` rows for the stages that follow."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance draw keeps."""
    batches(spark)
    return quality.resample(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in one of the languages learned: those without letters go, and those that need more bits per character in
    the nearest language than its own texts of that length do."""
    batches(spark)
    rows = language_id.ROWS + language_id.LIMIT_ROWS
    drawn = language_id.training_sample(docs.where(~language_id.held_out(F.col("doc_id"))), rows=rows)
    samples = {k: v[:language_id.ROWS] for k, v in drawn.items()}
    others = {k: v[language_id.ROWS:] for k, v in drawn.items()}
    found = language_id.identify(docs.select(*COLUMNS), samples, pred_col="__lang", score_col="__score", known_col="__known", others=others)
    return found.where("__known").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (5-word shingles, Jaccard of 0.8 or more)."""
    batches(spark)
    groups = ngram_jaccard.jaccard_components(docs, n=5, num=80, den=100)
    others = written(groups.where("component_id <> doc_id").select("doc_id").distinct(), "near-duplicates")
    return docs.select(*COLUMNS).join(others, "doc_id", "left_anti").select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that aligns with a benchmark item."""
    batches(spark)
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    ids = written(found.select(F.col("doc_id").alias("bad_id")).distinct(), "contaminated")
    return docs.select(*COLUMNS).join(ids, F.col("doc_id").eqNullSafe(F.col("bad_id")), "left_anti")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document that is left, checked to decode losslessly."""
    batches(spark)
    vocabulary = pieces.load_vocabulary(VOCABULARY)
    coded = pieces.encode(docs.select("doc_id", "text", "lang"), vocabulary, lossless_col="lossless", drop_text=True)
    return coded.select("doc_id", "lang", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("pieces", encode_pieces),
]

# The stages' models cannot be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to the whole documents table; between them rows are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
