"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What right results need; all else is left to the caller. Writers name their overwrite mode themselves.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def _shared_base(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; only a local session may go without and gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sensorpipe-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path that all executors share."""
    return f"{_shared_base(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small frame."""
    _shared_base(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, compression: str = "snappy", path: str | None = None) -> DataFrame:
    """Write the rows once, by default to a fresh shared folder, and read them back: a cut in the lineage.

    A folder made here is deleted when the application ends; ``drop_staged`` deletes it before.
    """
    spark = df.sparkSession
    if path is None:
        path = shared_dir(spark, "stage")
        folder = _folder(spark, path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the folders that ``staged`` made and ``df`` reads; nothing else may read them afterwards."""
    spark, base = df.sparkSession, _shared_base(df.sparkSession)
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    for path in folders:
        if path.rsplit("/", 1)[0].split(":")[-1].lstrip("/") == base.split(":")[-1].lstrip("/") and "/stage-" in path:
            folder = _folder(spark, path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _folder(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)
