"""Filtering stages drop the right rows when files are split otherwise between two reads."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from sensorpipe.llm import exact, simhash, toxicity


def test_stages_hold_when_splits_move(spark, tmp_path, monkeypatch):
    rows = spark.range(600).select("id", F.sha2(F.col("id").cast("string"), 256).alias("own"))
    texts = F.when(F.col("id") % 3 == 0, F.lit("bad words here")).otherwise(F.concat_ws(" ", *[F.sha2(F.concat("own", F.lit(str(i))), 256) for i in range(9)]))
    rows.select(F.col("id").alias("doc_id"), texts.alias("text")).repartition(6).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def moved(f):
        """``f`` with its result found under the splits of now, and all reads after it under others."""

        def run(*args, **kwargs):
            found = f(*args, **kwargs)
            path = str(tmp_path / f.__name__)
            found.write.mode("overwrite").parquet(path)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            return spark.read.parquet(path)

        return run

    def score(numbered, model):
        return numbered.select("row", (F.col("text") == "bad words here").cast("double").alias("score"))

    monkeypatch.setattr(toxicity, "train", lambda *args: None)
    monkeypatch.setattr(toxicity, "score", moved(score))
    monkeypatch.setattr(exact, "exact_duplicates", moved(exact.exact_duplicates))
    monkeypatch.setattr(simhash, "near_duplicates", moved(simhash.near_duplicates))
    clean = Counter(i for i in range(600) if i % 3)
    spark.range(0).write.parquet(f"{tmp_path}/labels.parquet")
    for stage, want in ((corpus_pipeline.drop_toxic, clean), (corpus_pipeline.drop_copies, clean + Counter([597])), (corpus_pipeline.drop_near_copies, clean + Counter([0]))):
        try:
            assert Counter(r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()) == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
            spark.conf.set("spark.sql.files.openCostInBytes", before[1])
