"""Token ids of a corpus in Simple-8b words, in ascending document order.

The format is a folder of Parquet files, one row for each run of whole documents ("block row"), so that Spark's
commit protocol and any file system it reaches serve: shard (the partition, ascending with doc_id), first (ids of
the shard before the row), doc_ids and doc_counts (ids of each document), words (Simple-8b words, little-endian),
offsets (the word where each block of BLOCK ids starts). A reader takes block rows in any order and decodes each
with numpy at once; the sums of the shards, a few rows, place them in the corpus.

Memory: a task holds one Arrow batch of texts and one block row of about ROW_IDS ids, or of one document if that is
longer. One range shuffle by doc_id.

Nulls: a null text is empty (only the end id); null doc_ids come first. Repeated doc_ids stand side by side, in any
order. Other columns of documents are ignored. No documents give an empty folder that reads as no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import encoder, linking, shared, simple8b

ROW_IDS = 32_768
FORMAT = "shard int, first long, n_ids long, doc_ids array<bigint>, doc_counts array<bigint>, words binary, offsets array<int>"


def write(documents: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encodes every whole text with the tokenizers library, appends end_id to each, and writes the folder."""

    def rows(batches):
        shard, first, held, ids, counts = TaskContext.get().partitionId(), 0, [], [], []
        tokens = encoder.encoder(tokenizer)

        def row():
            nonlocal first
            flat = np.concatenate(held)
            words, offsets = simple8b.encode(flat)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([len(flat)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([words.astype("<u8").tobytes()], pa.binary()), pa.array([offsets.tolist()], pa.list_(pa.int32()))],
                names=["shard", "first", "n_ids", "doc_ids", "doc_counts", "words", "offsets"],
            )
            first += len(flat)
            for x in (held, ids, counts):
                x.clear()
            return out

        end, size = np.array([end_id], np.uint32), 0
        for batch in batches:
            own = batch.column("doc_id").to_pylist()
            for a, b, flat, bounds in tokens.encode(batch.column("text").to_pylist()):
                for i in range(a, b):
                    part = flat[bounds[i - a] : bounds[i - a + 1]]
                    held += [part, end]
                    ids.append(own[i])
                    counts.append(len(part) + 1)
                    size += len(part) + 1
                    if size >= ROW_IDS:
                        yield row()
                        size = 0
        if ids:
            yield row()

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), shared.whole_text().alias("text"))
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(rows, FORMAT).write.option("compression", "zstd").mode("overwrite").parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Block rows with the ids of the corpus before them; the shards, a row each, are summed in one window."""
    rows = spark.read.schema(FORMAT).parquet(path)
    shards = rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(linking.small(shards.select("shard", before.alias("before"))), "shard")


def _decoded(batch):
    """(corpus start, doc_ids, doc_counts, ids) of each block row."""
    names = ("before", "first", "n_ids", "doc_ids", "doc_counts", "words", "offsets")
    for before, first, n, docs, counts, words, offsets in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
        yield before + first, docs, counts, simple8b.decode(np.frombuffer(words, "<u8"), np.array(offsets, np.int64), n).astype("<u4")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids."""

    def rows(batches):
        for batch in batches:
            for start, docs, counts, flat in _decoded(batch):
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + ends - counts, pa.int64()), pa.array([flat[b - a : b].astype(np.int32) for a, b in zip(counts, ends, strict=True)], pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])

    return _placed(spark, path).mapInArrow(rows, "doc_id long, start long, ids array<int>")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what the files hold."""

    def rows(batches):
        for batch in batches:
            for start, docs, counts, flat in _decoded(batch):
                ends = np.cumsum(counts)
                crc = [zlib.crc32(flat[b - a : b].tobytes()) for a, b in zip(counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _placed(spark, path).mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")
