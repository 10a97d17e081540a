"""Small file-system helpers on top of the Hadoop API that Spark itself uses."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def working_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="boxlake-")
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


class Working:
    """Intermediate tables of one run, written once and read back by several consumers.

    A written table outlives lost executors and keeps a payload from being parsed again
    for every output derived from it.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or working_root(spark)}/boxlake-{uuid.uuid4().hex}"
        self.kept = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.kept += 1
        path = f"{self.root}/{self.kept:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        fs, where = file_system(self.spark, self.root)
        fs.delete(where, True)
