"""Landed scans as a stream: a micro-batch rewrites the rows of the brands that it scans, and no others.

The store's rows lie in store/version=N/marka=M: a batch of number N writes the brands that it touched under its own number. brands/vN has a
row for each brand: what brands.after() tells of its scans, and the version under which its rows lie. A snapshot is a join of
the two on both partition columns, so Spark reads the folders of current rows alone. A repeated batch writes what it wrote before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import brands as B

STORE = "tekil_key string, marka string, bayi_adi string, il string, ilce string, adres string, telefon string, rol string, durum string, kayip_sayaci int, ilk_gorulme timestamp, son_gorulme timestamp"
SCAN = "marka string, bayi_adi string, il string, ilce string, adres string, telefon string, rol string, kapsam double, elle boolean, tarih timestamp"


def brands(spark: SparkSession, base: str, version: int) -> DataFrame:
    """Brand rows, and version: where the brand's store rows lie."""
    schema = f"{B.BRANDS}, version int"
    return spark.read.schema(schema).parquet(f"{base}/brands/v{version}") if version else spark.createDataFrame([], schema)


def snapshot(spark: SparkSession, base: str, version: int, of: DataFrame | None = None) -> DataFrame:
    """The store's rows after a batch; of: their brands (marka) if not all."""
    if not version:
        return spark.createDataFrame([], STORE)
    current = brands(spark, base, version).select("marka", "version")
    current = current if of is None else current.join(of, "marka", "left_semi")
    rows = spark.read.schema(f"{STORE}, version int").parquet(f"{base}/store")
    return rows.join(current, ["marka", "version"]).select(*(x.split()[0] for x in STORE.split(", ")))


def run(spark: SparkSession, landed: str, base: str, checkpoint: str) -> int:
    """Merges all landed scan files (JSON lines of SCAN), one a batch, and returns the last version. The stream ends with what is landed."""
    last = [0]

    def merge(batch: DataFrame, number: int) -> None:
        version = number + 1
        known = brands(spark, base, version - 1)
        touched = batch.select("marka").distinct()
        now = F.lit(batch.agg(F.max("tarih")).first()[0]).cast("timestamp")
        rows, events, told, log = B.commit(snapshot(spark, base, version - 1, touched), known.drop("version"), batch, now)
        rows.repartition("marka").write.mode("overwrite").partitionBy("marka").parquet(f"{base}/store/version={version}")
        events.write.mode("overwrite").parquet(f"{base}/log/v{version}")
        log.write.mode("overwrite").parquet(f"{base}/scans/v{version}")
        at = known.select("marka", "version").join(touched, "marka", "left_anti")
        told.join(at, "marka", "left").withColumn("version", F.coalesce("version", F.lit(version))).write.mode("overwrite").parquet(f"{base}/brands/v{version}")
        last[0] = version

    source = spark.readStream.schema(SCAN).option("maxFilesPerTrigger", 1).json(landed)
    source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return last[0]


def vacuum(spark: SparkSession, base: str, version: int) -> list[int]:
    """Removes store folders that lie before all that a snapshot of this version reads, and returns their numbers. Earlier snapshots are gone then."""
    least = brands(spark, base, version).agg(F.min("version")).first()[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/store")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [x.getPath() for x in files.listStatus(path) if x.getPath().getName().startswith("version=") and int(x.getPath().getName()[8:]) < (least or 0)]
    for x in old:
        files.delete(x, True)
    return sorted(int(x.getName()[8:]) for x in old)
