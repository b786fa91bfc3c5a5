"""Corpus pipeline: five stages over the documents table, each written as Parquet and reread by the next.

A stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the columns of
documents.  Classifiers learn from the labels of the documents that reached them.  Rows without doc_id go through the
deduplication stage untouched; rows repeated whole are one document there and stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlens.llm import bpe
from finlens.llm.decontaminate import Decontaminator
from finlens.llm.kit import stored
from finlens.llm.ngram_join import jaccard_groups
from finlens.llm.quality import NbSvm
from finlens.llm.queries import tokenizer_file
from finlens.llm.toxicity import OrdinalToxicity


TOKEN_BLOCK = 4 << 20  # bytes of text in a block of the last stage, which shares its executors with what earlier stages left


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the ordinal model calls toxic go."""
    engine = OrdinalToxicity()
    model = engine.fit(docs, _labels(spark, sf_dir), "toxic")
    return engine.predict(docs, model).where(~F.col("toxic")).select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents predicted to be of low quality go."""
    engine = NbSvm()
    model = engine.fit(docs, _labels(spark, sf_dir), "quality")
    return engine.predict(docs, model, 0.3).where("predicted = 1").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near copies the document with the least doc_id stays."""
    groups = jaccard_groups(docs, width=5, num=80, den=100)
    return docs.join(groups.where("component_id <> doc_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: benchmark passages are cut out of texts; documents that are mostly such passages go."""
    return Decontaminator(window=10).apply(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: token counts and digests of the ids and of the text decoded from them."""
    return bpe.digests(docs, tokenizer_file(), TOKEN_BLOCK)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("bpe", tokenize),
]

ORACLE_SQL = None  # the classifiers and BPE have no SQL; tests compare each stage with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
