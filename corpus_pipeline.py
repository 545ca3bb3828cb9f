"""A cleaning pipeline over ``documents``: each stage works on all that the one
before kept and returns the columns of documents, the last one the mix.

Rows without an id pass the stages that decide by id. An empty table gives an
empty mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutique.llm import decontaminate, dedup, mixing, secrets, toxicity
from boutique.llm.common import documents, scratch_path
from boutique.session import ensure_checkpoint_dir, ship_package
from boutique.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _stage(fn):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, docs, sf_dir)
    run.__name__ = fn.__name__
    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return toxicity.drop_toxic(docs.select(*COLUMNS), read_table(spark, sf_dir, "labels"))


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8) one row stays: the
    smallest id's, and of repeated rows of that id the first by text hash."""
    docs = docs.select(*COLUMNS)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("m")).where("m > 1").select("doc_id")
    gone = dedup.near_duplicates(docs, size=5, percent=80).where(~F.col("kept")).select("doc_id").distinct()
    first = F.min(F.struct(F.xxhash64("text").alias("h"), *COLUMNS[1:])).alias("r")
    one = (docs.join(repeated, "doc_id", "left_semi").join(gone, "doc_id", "left_anti").groupBy("doc_id").agg(first)
           .select("doc_id", *[F.col(f"r.{c}") for c in COLUMNS[1:]]))
    single = docs.join(gone.unionByName(repeated).distinct(), "doc_id", "left_anti")
    return single.unionByName(one)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


@_stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; every document stays."""
    return secrets.redact(docs.select(*COLUMNS))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
]

#: Trained and similarity stages have no SQL form; tests/llm has a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    docs = documents(spark, sf_dir)
    base = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
