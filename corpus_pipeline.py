"""From raw documents to tokens: five stages, each written as Parquet and read again by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorpipe.llm import bpe, exact, mixing, simhash, toxicity
from sensorpipe.llm.queries import VOCABULARY
from sensorpipe.llm.spread import numbered, without
from sensorpipe.session import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept, number = numbered(docs)
    scored = toxicity.score(kept.select(F.col(number).alias("row"), "text"), model)
    return without(kept, scored.filter("score >= 0.5"), number)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    kept, number = numbered(docs)
    return without(kept, exact.exact_duplicates(kept, number=number).filter("not kept"), number)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id."""
    kept, number = numbered(docs)
    return without(kept, simhash.near_duplicates(kept, number=number).filter("not kept"), number)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emit(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the tokens, their number, and the digest of what they decode to."""
    return bpe.tokens(docs.select("doc_id", "lang", "source", "text"), VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe", tokenize),
]

#: SQL has neither the trees nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
