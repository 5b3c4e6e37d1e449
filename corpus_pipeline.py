"""The corpus pipeline: language ID, exact dedup, near-duplicate removal, source mixing and
SentencePiece encoding, each stage on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, language_id, mixing, ngram_join, sentencepiece_codec
from tidemark.llm.storage import read_table, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with one more column that numbers its rows (ids may be null or repeat), and
    that column's name; stored, so that every reader sees the same numbers."""
    row = "_row"
    while row in {c.lower() for c in docs.columns}:
        row = "_" + row
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a recognised language (not ``und``, score of at least
    ``language_id.MIN_SCORE``).  Learns from the documents that op8 does not hold out."""
    model = language_id.fit(language_id.held_out(docs).where("not held_out"))
    rows = language_id.predict(docs, model)
    return rows.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= language_id.MIN_SCORE)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same normalised text, the smallest doc_id stays, with all rows
    that repeat it, and all rows with a null doc_id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents, the smallest doc_id stays, with all rows that
    repeat it.  Rows are judged by their own text; those with a null doc_id all stay."""
    rows, row = _numbered(docs, "near")
    parts = ngram_join.ngram_components(rows, row_col=row)
    lost = parts.where("doc_id <> component_id").select(row)
    return rows.join(lost, row, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per emission: documents of a source above its weight may go, those of a
    source below it may repeat.  Each row takes its own emissions, whatever its doc_id."""
    rows, row = _numbered(docs, "mix")
    return rows.join(mixing.mixture(rows, row_col=row).select(row), row).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``piece_ids`` and their number."""
    rows = sentencepiece_codec.encode(docs)
    return rows.withColumn("n_pieces", F.size("piece_ids").cast("long"))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("source mixing", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

#: Language models, components and Viterbi segmentations are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
