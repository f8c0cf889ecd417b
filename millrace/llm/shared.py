"""Tables in the folder that driver and executors share, and small helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, as in tests, a folder under the warehouse, which driver
    and executors share as well."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (found or f"{spark.conf.get('spark.sql.warehouse.dir')}/millrace-scratch").rstrip("/")


def collect(spark: SparkSession) -> None:
    """Spark removes the shuffle files of plans that the driver no longer holds."""
    spark._jvm.java.lang.System.gc()


class Scratch:
    """Parquet tables under one new folder of the shared one. save() cuts the lineage: what follows reads the
    committed files, so a lost executor costs no more than its running tasks."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """df as a table of that name. A name that is there is an error: what still reads it would lose its files."""
        df.write.mode("error").parquet(f"{self.path}/{name}")
        found = self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")
        del df
        collect(self.spark)
        return found

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def drop(self, name: str = "") -> None:
        path, files = self._at(name)
        files.delete(path, True)

    def keep(self, *names: str) -> None:
        """Drops all tables but these."""
        path, files = self._at("")
        for x in files.listStatus(path):
            if x.getPath().getName() not in names:
                files.delete(x.getPath(), True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text"):
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))
