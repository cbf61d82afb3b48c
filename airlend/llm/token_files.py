"""Token ids of documents in files of Simple-8b segments, in ascending doc_id order.

`write_tokens` range-sorts the documents, encodes them and writes Parquet files whose rows are segments: the
ids of consecutive whole documents as one Simple-8b payload (see simple8b), with their doc_ids, lengths and the
place of the segment in its shard. A shard is one range of the order. `read_tokens` gives the documents back.

Null texts are empty: they hold the end id only. Documents of one doc_id follow each other in the order of a
hash of their text; repeated rows are kept; a null doc_id comes first. No document is split over segments, so a
segment is about SLICE_BYTES of text or one very long document. An empty table gives files without rows.
Other columns of the documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlend.llm import simple8b
from airlend.llm.common import keyed, partitions
from airlend.llm.tokens import library_encoder

SEGMENTS = (
    "shard int, segment int, first long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"
)
DOCUMENTS = "shard int, segment int, doc_id long, at long, n_tokens long, ids binary"


def _with_ends(values: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end_id` after each document, and each document's length with it."""
    lengths = np.diff(offsets)
    number = np.arange(len(lengths))
    out = np.empty(len(values) + len(lengths), np.uint32)
    out[np.arange(len(values)) + np.repeat(number, lengths)] = values
    out[offsets[1:] + number] = end_id
    return out, lengths + 1


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the ids of all documents to the new folder `path`."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        encoder = library_encoder(tokenizer)
        for batch in batches:
            at = 0
            for values, offsets in encoder.encode(batch["text"]):
                ids, lengths = _with_ends(values, offsets, end_id)
                doc_ids = batch["doc_id"].slice(at, len(lengths)).to_pylist()
                at += len(lengths)
                row = (shard, segment, first, len(ids), doc_ids, lengths.tolist(), simple8b.encode(ids))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)
                segment, first = segment + 1, first + len(ids)

    names = [x.split()[0] for x in SEGMENTS.split(", ")]
    many = pa.list_(pa.int64())
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), many, many, pa.binary()]
    spark = docs.sparkSession
    rows = keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    ranged = rows.repartitionByRange(partitions(spark), "doc_id", "th").sortWithinPartitions("doc_id", "th")
    ranged.select("doc_id", "text").mapInArrow(segments, SEGMENTS).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32 bit, little-endian)."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(row["payload"]).astype("<u4")
                n, lengths = len(row["lengths"]), np.array(row["lengths"], "i8")
                ends = np.cumsum(lengths)
                data, bounds = ids.tobytes(), (4 * np.concatenate([[0], ends])).tolist()
                columns = [
                    pa.array([row["shard"]] * n, pa.int32()),
                    pa.array([row["segment"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["first"] + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([data[a:b] for a, b in zip(bounds, bounds[1:])], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [x.split()[0] for x in DOCUMENTS.split(", ")]
    stored = spark.read.schema(SEGMENTS).parquet(path)
    # One row for each shard, so as many as the writing job had tasks.
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    before = np.concatenate([[0], np.cumsum([row["n"] for row in totals], dtype="i8")]).tolist()
    starts = spark.createDataFrame([(row["shard"], b) for row, b in zip(totals, before)], "shard int, before long")
    found = stored.mapInArrow(documents, DOCUMENTS).join(F.broadcast(starts), "shard")
    return found.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")

