"""A corpus pipeline of five operators: documents that the quality classifier
rejects go, recurring lines are dropped, one document of each near-duplicate
group stays, documents with benchmark passages go, and the rest is encoded
by a byte-level BPE tokenizer and decoded again.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.  Nulls, empty texts and repeated
rows are handled as the operators define; an empty table stays empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterfold.llm import bpe, decontam, line_crf, line_templates, simhash
from clusterfold.llm.frames import saved
from clusterfold.llm.queries import RANKS, fold
from clusterfold.session import checkpoint_dir
from clusterfold.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier scores 0.5 or more."""
    chain = line_crf.train(docs, table(spark, sf_dir, "labels"), fold(3) != 1)
    kept = line_crf.score(docs, chain).where(F.col("score") >= 0.5)
    return kept.select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the recurring lines that an earlier one keeps;
    ``n_chars`` follows the text."""
    left = line_templates.cleaned(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group."""
    return simhash.keep_first(docs, shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian uint32) and digests of the ids
    and of the decoded bytes.  The ids are saved in between: encoders and
    decoders, each a Python worker for a core, take turns in an executor."""
    path = public_tokenizers.path(RANKS)
    done = bpe.decode(saved(bpe.encode(docs, path, public_tokenizers.PATTERN)), path)
    return done.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", tokens),
]

#: SQL can express neither the classifier nor the fingerprints nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
