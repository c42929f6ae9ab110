"""From documents to token ids: toxic documents go, one document of each group
of near duplicates stays, secrets are masked, sources are mixed to their
weights, and the mix is encoded.

Each stage takes (spark, docs, sf_dir) and returns what it leaves of ``docs``;
all but the last return the columns of documents. A stage works on all that
the one before it left.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm import bpe, jaccard, mixing, secrets, toxicity
from netloom.session import materialize, scratch_root


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the grammar scores 0.5 or more. It learns
    from the labels of the documents it is given, other than those held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels, toxicity.may_learn(F.col("doc_id")))
    name = "toxicity"
    while any(c.lower().startswith(name) for c in docs.columns):
        name = f"_{name}"
    return toxicity.score(docs, model, name).where(F.col(name) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles."""
    return jaccard.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets found in it masked."""
    ledger = secrets.Ledger(spark, f"{scratch_root(spark)}/ledger-{uuid.uuid4().hex}")
    return secrets.redact(docs, ledger)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time."""
    return mixing.take(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids) of every row."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Learned scores, components and merges have no SQL; tests check stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
