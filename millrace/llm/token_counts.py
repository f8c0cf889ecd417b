"""Token counts with a digest cache.

A text's key is the SHA-256 of its normalised content together with a digest of the tokenizer's file. Rows whose key
the cache holds take the stored count. Each distinct missing text is encoded once, and its count appended to the cache
(a Parquet folder; an aborted run leaves nothing in it). The normalisation must not change the count: the one here only
makes a null text empty.

Memory: one Arrow batch of texts a task. The join by digest is between a row for each document and one for each
distinct text; a text that a third of the rows share meets before the shuffle, and its rows are split by AQE.

Nulls: a null text counts as empty (0 bytes, 0 tokens); null doc_ids stay. Repeated rows are each counted. Other
columns are ignored. No documents give no rows and leave the cache as it is.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

_models: dict = {}


def version(path: str) -> str:
    """The digest that stands for a tokenizer's file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def counter(path: str):
    """texts -> token counts, by the library that the file is for; once for each worker."""
    if path not in _models:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _models[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from . import encoder

            tokens = encoder.encoder(path)
            _models[path] = lambda texts: [int(bounds[i + 1] - bounds[i]) for a, b, _, bounds in tokens.encode(texts) for i in range(b - a)]
    return _models[path]


def _cached(spark: SparkSession, path: str, of: str) -> DataFrame | None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema("digest binary, version string, n_tokens long").parquet(path).filter(F.col("version") == of)


def count(spark: SparkSession, documents: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every document; what the cache at that path lacks is appended to it."""
    of = version(tokenizer)
    docs = documents.select("doc_id", shared.whole_text().alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    stored = _cached(spark, cache, of)
    missing = docs if stored is None else docs.join(stored, "digest", "left_anti")

    def counted(batches):
        count_of = counter(tokenizer)
        for batch in batches:
            n, texts, at = [], batch.column("text"), 0
            while at < len(texts):  # some texts at a time
                n += count_of(texts.slice(at, 64).to_pylist())
                at += 64
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array([of] * len(n), pa.string()), pa.array(n, pa.int64())], names=["digest", "version", "n_tokens"])

    distinct = missing.groupBy("digest").agg(F.first("text").alias("text"))
    distinct.mapInArrow(counted, "digest binary, version string, n_tokens long").write.mode("append").parquet(cache)
    known = _cached(spark, cache, of).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return docs.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(known, "digest").select("doc_id", "n_bytes", "n_tokens")
