"""Corpus preparation: a chain of operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``.  A table without rows passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import mixing, ngramjoin, pieces, queries, secrets, toxicity
from larkspur.llm.workspace import Workspace

#: Scores from here on are toxic.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the toxicity classifier puts at 0.5 or more."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5)
    return toxicity.keep_clean(docs, model, TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that links of 5-word shingles join (Jaccard 0.75 or more)."""
    return ngramjoin.keep_one(docs, k=5, percent=75)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays."""
    return secrets.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document once, and repeats documents until the sources reach their share of 1.25 times the tokens."""
    return mixing.apply(docs, queries.mixture(budget=(5, 4), floor_epochs=1, max_epochs=3))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, per row of the mixture."""
    return pieces.round_trip(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), queries.tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode),
]

#: The first stage trains a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents`` of ``sf_dir``."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name.split()[0])
        if before is not None:
            ws.drop(before)
        before = docs
    return docs
