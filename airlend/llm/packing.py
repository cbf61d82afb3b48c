"""Best-fit packing of documents into sequences of at most `capacity` tokens.

`token_pieces` turns documents into pieces: a document's ids and an end id, cut only if they are longer than a
sequence; then the first piece takes what is over and all others are full. `best_fit` packs pieces.

Bulk-synchronous best-fit: the pieces are range-sorted by length, which gives each its rank among the pieces of
its length. A superstep takes the pieces of one length, longest first, and matches all of them at once: the
smallest gap that holds them (the successor of the length in the sorted gaps) takes as many as it has
sequences, the k-th piece by rank goes to the k-th sequence of the gap, what is left looks for the next gap,
and if there is none, new sequences are opened and filled. Gaps are updated and the next superstep follows.
Documents of one length and sequences of one gap are told apart by rank only, so both are kept as runs
(length, first rank, how many): the sweep sees one row for each length, at most `capacity`, however many
documents there are, and the documents themselves take part in two distributed steps: the range sort and the
join of each with the run that its rank lies in. The result is that of best-fit decreasing, document by document.

Null texts are empty (the end id only). Repeated rows are packed each. Ties in length go by doc_id, piece and
checksum. An empty table gives no rows. Other columns of the documents are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlend.llm.common import dense_order, keyed, stage
from airlend.llm.token_files import _with_ends
from airlend.llm.tokens import library_encoder

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_RUNS = "length long, first long, runs array<struct<rank:long,n:long,sequence:long,offset:long>>"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece (from 0), start (the document's ids before it), length, ids_crc32."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        for batch in batches:
            at = 0
            for values, offsets in encoder.encode(batch["text"]):
                ids, lengths = _with_ends(values, offsets, end_id)
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                count = -(-lengths // capacity)
                number = np.repeat(np.arange(len(lengths)), count)
                piece = np.arange(len(number)) - np.repeat(np.cumsum(count) - count, count)
                over = (lengths - (count - 1) * capacity)[number]
                start = np.where(piece > 0, over + (piece - 1) * capacity, 0)
                size = np.where(piece > 0, capacity, over)
                begin = (np.cumsum(lengths) - lengths)[number] + start
                bounds = zip((4 * begin).tolist(), (4 * (begin + size)).tolist())
                checks = [zlib.crc32(data[a:b]) for a, b in bounds]
                doc_ids = batch["doc_id"].slice(at, len(lengths)).take(pa.array(number))
                at += len(lengths)
                columns = [doc_ids, pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(checks)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [x.split()[0] for x in PIECES.split(", ")]
    rows = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pieces, PIECES)


def place_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Supersteps over the lengths: runs (length, first rank, how many, first sequence, offset)."""
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError("a piece must have at least one token and no more than a sequence holds")
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap to runs (first sequence, how many)
    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (gap := min((g for g in gaps if g >= length), default=0)):
            sequence, n = gaps[gap].pop()
            take = min(n, left)
            placed.append((length, rank, take, sequence, capacity - gap))
            if n > take:
                gaps[gap].append((sequence + take, n - take))
            if not gaps[gap]:
                del gaps[gap]
            if gap > length:
                gaps.setdefault(gap - length, []).append((sequence, take))
            rank, left = rank + take, left - take
        each = capacity // length
        for n, filled in ((left // each, each), (1, left % each)):
            if n and filled:
                for k in range(filled):
                    placed.append((length, rank, n, opened, k * length))
                    rank += n
                if capacity > filled * length:
                    gaps.setdefault(capacity - filled * length, []).append((opened, n))
                opened += n
    return placed


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The columns of token_pieces with sequence_id and offset."""
    spark = pieces.sparkSession
    ordered = dense_order(stage(pieces, "pieces"), "length", "doc_id", "piece", "ids_crc32")
    # At most `capacity` rows.
    counts = {row["length"]: row["count"] for row in ordered.groupBy("length").count().collect()}
    runs: dict[int, list] = {}
    for length, *run in place_runs(counts, capacity):
        runs.setdefault(length, []).append(tuple(run))
    table, first = [], 0
    for length in sorted(counts):
        table.append((length, first, runs[length]))
        first += counts[length]
    found = ordered.join(F.broadcast(spark.createDataFrame(table, _RUNS)), "length")
    rank = F.col("pos") - F.col("first")
    run = F.filter("runs", lambda r: (r["rank"] <= rank) & (rank < r["rank"] + r["n"]))[0]
    found = found.withColumn("run", run)
    return found.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("run.sequence") + rank - F.col("run.rank")).alias("sequence_id"),
        F.col("run.offset").alias("offset"),
    )
