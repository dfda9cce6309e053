"""A corpus cleaned in five stages: toxicity, line dedup, near-duplicate groups, benchmark decontamination, piece encoding.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as the next one's docs.
All but the last return the columns of `documents`; the last returns each document's id, piece count, digest of its codes
and whether they decode to its text.

Defined results: a null text is an empty one, which no stage drops.  Rows without doc_id pass every stage but the first, which
judges their text like any other.  Rows that repeat a doc_id are judged by their own text in the first stage and as one document in
the others.  Columns beyond those of `documents` pass through all but the last stage, whatever their names.  An empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import decontaminate, line_dedup, ngram_join, sentencepiece, toxicity
from strandloom.llm.common import documents, free_name, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score reaches the threshold go; the model learns from the labels of what the input holds. A null text has the bias alone."""
    model = toxicity.train(docs, toxicity.training_labels(spark, sf_dir))
    score = free_name(docs, "toxicity")
    return toxicity.score(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose repeated lines; n_chars follows. Documents stay, even if nothing is left of them; a null text becomes an empty one.
    Of documents that share a line the one of the largest id keeps it."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document of the smallest id stays. Texts without words, and rows without id, are in no group."""
    return ngram_join.keep_representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Empty texts hold none; rows without id stay."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a row; an empty text has no pieces."""
    return sentencepiece.encoded_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: Scores of a trained model decide the first stage and a lattice the last, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
