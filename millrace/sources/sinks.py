"""Result files, written by Spark: delimited, JSON payloads, one folder a key, manual-source lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ";", quote_all: bool = False) -> None:
    """A header and, in the first column's name, the byte order mark that spreadsheet programs look for."""
    marked = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    marked.write.mode("overwrite").option("sep", sep).option("header", True).option("quoteAll", quote_all).csv(path)


def write_by_key(df: DataFrame, path: str, key: str) -> None:
    """A folder for each key, as a workbook has sheets."""
    df.repartition(key).write.mode("overwrite").partitionBy(key).parquet(path)


def payload(df: DataFrame, by: str) -> DataFrame:
    """by, rows (a JSON list of its rows in order of all columns). A list is one page's data, so it is small."""
    return df.groupBy(by).agg(F.to_json(F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c != by])))).alias("rows"))


def content_hash(df: DataFrame) -> DataFrame:
    """One row: n and a hash that doesn't depend on order, to compare what was written with what is read. Hashes are summed, so that equal rows count."""
    total = F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).cast("string")
    return df.agg(F.count("*").alias("n"), F.coalesce(total, F.lit("0")).alias("hash"))
