"""Byte-level BPE by a rank file: encoding with a hierarchical-bitmap rank queue, and decoding.

Each match of the pre-token pattern is encoded alone. Its bytes form a linked list; every neighbouring pair
whose bytes have a rank waits in the bucket of that rank, which holds list positions. A bitmap of two levels,
words of 256 bits below and a bit for each word above, marks the buckets in use, so the next rank is found by two
find-first-set steps whatever the length; of equal pairs the leftmost goes first. An entry whose pair has meanwhile changed is stale and
skipped. A pre-token of n bytes takes O(n log n), so very long ones do no harm.

`encode` gives doc_id and ids (array<int>), `decode` adds the bytes of ids. Null texts are empty: no ids.
Rows are handled one by one, so repeated rows repeat; a null doc_id is kept. Null ids decode to null; an id
outside the file is an error. Other columns are not read by `encode` and kept by `decode`.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend.llm.common import keyed
from airlend.llm.tokens import PartEncoder


#: Bits in a word of the bitmap.
WORD_BITS = 256


class RankEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        most = max(ranks.values(), default=0) + 1
        #: Positions by rank, each bucket a heap; and a bit for each bucket in use. All are empty between merges.
        self.buckets: list[list[int]] = [[] for _ in range(most)]
        self.low = [0] * (most // WORD_BITS + 1)
        self.bit = [1 << k for k in range(max(WORD_BITS, len(self.low)))]

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token."""
        rank_of = self.ranks.get
        whole = rank_of(data)
        if whole is not None:
            return [whole]
        buckets, low, bit, top = self.buckets, self.low, self.bit, 0  # top: a bit for each word of low in use
        n = len(data)
        end = list(range(1, n + 1))  # where the part that begins here ends; the next part begins there
        before = list(range(-1, n))
        # The rank of this part and the next; None also for no part.
        pair = [rank_of(data[at : at + 2]) for at in range(n - 1)]
        pair.append(None)
        for at, rank in enumerate(pair):
            if rank is not None:
                bucket = buckets[rank]
                if not bucket:
                    word = rank // WORD_BITS
                    low[word] |= bit[rank % WORD_BITS]
                    top |= bit[word]
                bucket.append(at)  # positions ascend, so the bucket stays a heap
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = word * WORD_BITS + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                at = heappop(bucket)
            else:
                at = bucket.pop()
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if pair[at] != rank:
                continue
            taken = end[at]
            stop = end[at] = end[taken]
            pair[taken] = None
            changed = []
            if stop < n:
                before[stop] = at
                pair[at] = rank = rank_of(data[at : end[stop]])
                if rank is not None:
                    changed.append((rank, at))
            else:
                pair[at] = None
            back = before[at]
            if back >= 0:
                pair[back] = rank = rank_of(data[back:stop])
                if rank is not None:
                    changed.append((rank, back))
            for rank, at in changed:
                bucket = buckets[rank]
                if not bucket:
                    word = rank // WORD_BITS
                    low[word] |= bit[rank % WORD_BITS]
                    top |= bit[word]
                heappush(bucket, at)
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[data[at : end[at]]])
            at = end[at]
        return ids

    def encode_many(self, texts: list[str]) -> list[bytes]:
        found = []
        for text in texts:
            ids = array("I")
            for token in self.pattern.findall(text):
                ids.extend(self.merge(token.encode()))
            found.append(ids.tobytes())
        return found


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> PartEncoder:
    """One for each worker process and file."""
    return PartEncoder(RankEncoder(read_ranks(path), pattern).encode_many)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.Array:
    """The bytes of each id, null for numbers that are none."""
    known = {rank: token for token, rank in read_ranks(path).items()}
    return pa.array([known.get(k) for k in range(max(known, default=-1) + 1)], pa.large_binary())


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and ids. `pattern` must cut where airlend.llm.tokens says, as public_tokenizers.PATTERN does."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(rank_file, pattern)
        for batch in batches:
            at = 0
            for values, offsets in encoder.encode(batch["text"]):
                bounds = pa.array(offsets.astype(np.int32))
                lists = pa.ListArray.from_arrays(bounds, pa.array(values.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, len(lists)), lists], ["doc_id", "ids"])
                at += len(lists)

    rows = keyed(docs).select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return rows.mapInArrow(ids, T.StructType(fields))


def _joined(ids: pa.Array, known: pa.Array) -> pa.Array:
    """The bytes of each list of ids."""
    found = known.take(ids.flatten())
    if found.null_count:
        raise ValueError("an id is not in the rank file")
    ends = np.cumsum(pc.binary_length(found).to_numpy())
    places = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy().astype("i8"))])
    data = found.buffers()[2] or pa.py_buffer(b"")
    offsets = pa.py_buffer(np.concatenate([[0], ends])[places].astype("i8"))
    whole = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, offsets, data])
    return pc.if_else(ids.is_valid(), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def decode(encoded: DataFrame, rank_file: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns and the bytes of `ids`."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = token_bytes(rank_file)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _joined(batch[ids], known)], names=[*batch.schema.names, to])

    kept = encoded.select(*[F.col(c) for c in encoded.columns if c != to])
    return kept.mapInArrow(texts, T.StructType([*kept.schema.fields, T.StructField(to, T.BinaryType())]))
