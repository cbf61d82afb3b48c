"""Removes bytes that are covered by a string of `length` bytes which also starts anywhere else.

A sparse suffix array over UTF-8 bytes. Every start of a string of `length` bytes belongs to one anchor, the place
in it with the least hash of GRAM bytes (winnowing; the first of equal ones), which equal strings have at equal
distance. So only suffixes at anchors are sorted, about one for 76 bytes, each with the bytes around it that
the strings of its starts cover (its context).

1. All texts give the hashes of their anchors. Anchors whose hash occurs at one place only are dropped; of texts
   that are equal as a whole, one stands for all.
2. The contexts of the others are range-partitioned by the bytes that lead their suffix, with sampled splitters,
   then by context, text and place, so that one very common passage fills as many partitions as it needs.
3. In its bucket every context that equals another is settled at once, and only one of them is sorted. The starts
   of all others are sorted by multikey quicksort, eight bytes a level, keeping what is still tied.
4. Buckets compare across boundaries: groups of equal leading bytes that begin or end a bucket may continue in
   another one, so the 128-bit digests of their strings are counted over all buckets.

Matches never cross documents; strings are judged on the input. Null texts are empty. Documents are told apart
by doc_id and text: rows that repeat both are one document and share its result; a text that occurs under two
doc_ids is removed from both if it has `length` bytes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlend.llm.common import keyed, partitions, stage
from airlend.llm.near_dups import _mixed, _slices

LENGTH = 200
GRAM = 50
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ANCHORS = "h long, anchor long, th long, p int"
_CONTEXTS = "lead binary, th long, p int, first int, last int, context binary"
_COVERED = "th long, lo int, hi int, digest binary, bucket int"


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up, down = np.full(n, _BASE), np.full(n, np.uint64(pow(int(_BASE), -1, 2**64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """text, place, first start, last start, hash of every anchor; all places are relative to the text."""
    sizes = np.array([len(t) for t in texts], "i8")
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.empty(0, kind) for kind in ("i8", "i8", "i8", "i8", "u8"))
    up, down = _powers(max(22, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
    grams = len(data) - GRAM + 1
    hashes = _mixed((sums[GRAM:] - sums[:grams]) * down[:grams])
    del sums
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    window, span = length - GRAM + 1, 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[window - span : window - span + n])
    place = (least & np.uint64(0xFFFFFFFF)).astype("i8")
    # Starts whose string ends in its own text.
    text = np.repeat(np.arange(len(texts)), sizes)[:n]
    starts = np.flatnonzero(np.arange(n) + length <= ends[text])
    place, text = place[starts], text[starts]
    change = np.ones(len(starts), bool)
    change[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(change)
    finish = np.append(begin[1:], len(starts)) - 1
    text, base = text[begin], (ends - sizes)[text[begin]]
    return text, place[begin] - base, starts[begin] - base, starts[finish] - base, hashes[place[begin]]


def _anchor_rows(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                texts = part["text"].cast(pa.large_binary()).to_pylist()
                text, place, _, _, hashes = anchors(texts, length)
                th = part["th"].to_numpy()[text]
                name = _mixed(th.view("u8") ^ _mixed(place.astype("u8")))
                columns = [hashes.view("i8"), name.view("i8"), th, place.astype("i4")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "anchor", "th", "p"])

    return rows


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd frames, which take less room in a shuffle."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = pa.array([pack(t) for t in batch["text"].cast(pa.large_binary()).to_pylist()], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", texts)


def _context_rows(length: int):
    names = [c.split()[0] for c in _CONTEXTS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(len(batch)):
                text = unpack(batch["text"][at].as_py())
                _, place, first, last, _ = anchors([text], length)
                wanted = np.isin(place, batch["places"][at].values.to_numpy())
                place, first, last = place[wanted], first[wanted], last[wanted]
                bounds = list(zip(place.tolist(), first.tolist(), (last + length).tolist()))
                columns = [
                    pa.array([text[p : p + GRAM] for p, _, _ in bounds], pa.binary()),
                    pa.array([batch["th"][at].as_py()] * len(place), pa.int64()),
                    pa.array(place, pa.int32()),
                    pa.array(first, pa.int32()),
                    pa.array(last, pa.int32()),
                    pa.array([text[a:b] for _, a, b in bounds], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def multikey_ties(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the strings of `length` bytes at places `at` within groups, eight bytes a level. Which of them equal
    another one of their group, in order, and where in that order each set of equal ones begins."""
    words = np.ndarray(max(len(data) - 7, 0), ">u8", data, strides=(1,))
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    index = np.arange(len(at))
    for step in steps:
        if not len(index):
            break
        key = words[at[index] + step].astype("u8")
        order = np.lexsort((key, group))
        index, group, key = index[order], group[order], key[order]
        change = np.ones(len(index), bool)
        change[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(change) - 1
        tied = np.bincount(group)[group] > 1
        index, group = index[tied], group[tied]
    return index, np.unique(group, return_index=True)[1] if len(index) else index


def _bucket(length: int):
    names = [c.split()[0] for c in _COVERED.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]

    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if len(b)]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        lead = table["lead"].combine_chunks().dictionary_encode().indices.to_numpy().astype("i8")
        th, p, first, last = (table[c].to_numpy().astype("i8") for c in ("th", "p", "first", "last"))
        # A repeated row gives its contexts again.
        _, once = np.unique(_mixed(th.view("u8") ^ _mixed(p.view("u8"))), return_index=True)
        table, lead, th, p, first, last = table.take(pa.array(once)), lead[once], th[once], p[once], first[once], last[once]
        contexts = table["context"].combine_chunks()
        same = contexts.dictionary_encode().indices.to_numpy().astype("i8")
        # Equal contexts whose anchor is at the same place in them.
        _, same, count = np.unique(same * 4096 + (p - first), return_inverse=True, return_counts=True)
        yield from written(th[count[same] > 1], first[count[same] > 1], last[count[same] > 1] + length)
        _, one = np.unique(same, return_index=True)
        groups = np.bincount(lead[one])
        edge = edges(table)
        one = one[(groups[lead[one]] > 1) | edge[one]]
        if not len(one):
            return
        texts = contexts.take(pa.array(one)).to_pylist()
        data = np.frombuffer(b"".join(texts), np.uint8)
        base = np.cumsum([0] + [len(t) for t in texts[:-1]])
        starts = last[one] - first[one] + 1
        of = np.repeat(np.arange(len(one)), starts)
        shift = np.arange(len(of)) - np.repeat(np.cumsum(starts) - starts, starts)
        at = base[of] + shift
        back = (p[one] - first[one])[of] - shift
        tied, firsts_of_ties = multikey_ties(data, at, lead[one][of] * 4096 + back, length)
        hit = np.zeros(len(at), bool)
        hit[tied] = True
        # Runs of tied starts of one context.
        change = np.ones(len(at), bool)
        change[1:] = (of[1:] != of[:-1]) | (hit[1:] != hit[:-1])
        begin = np.flatnonzero(change)
        finish = np.append(begin[1:], len(at)) - 1
        begin, finish = begin[hit[begin]], finish[hit[begin]]
        yield from written(th[one][of[begin]], (first[one][of] + shift)[begin], (first[one][of] + shift)[finish] + length)
        # Of equal strings found here one is enough for other buckets to see; it needs no answer itself.
        shown = np.ones(len(at), bool)
        shown[tied] = False
        shown[tied[firsts_of_ties]] = True
        out = np.flatnonzero(edge[one][of] & shown)
        view = memoryview(data)
        for part in np.array_split(out, max(1, len(out) // 100_000)):
            digests = [xxhash.xxh3_128_digest(view[a : a + length]) for a in at[part].tolist()]
            lo = (first[one][of] + shift)[part]
            yield from written(th[one][of[part]], lo, np.where(hit[part], lo, lo + length), digests)

    def edges(table: pa.Table) -> np.ndarray:
        """Rows whose group of equal leading bytes is the bucket's least or greatest."""
        leads = table["lead"].combine_chunks()
        ends = pc.min_max(leads.cast(pa.binary()))
        return pc.or_(pc.equal(leads, ends["min"]), pc.equal(leads, ends["max"])).to_numpy(zero_copy_only=False)

    def written(th, lo, hi, digests=None) -> Iterator[pa.RecordBatch]:
        n, bucket = len(th), TaskContext.get().partitionId()
        columns = [th, lo, hi, digests if digests else [None] * n, [bucket] * n]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return covered


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        rows = []
        for row in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "copied", "runs"))):
            doc_id, text, copied, runs = row[0], unpack(row[1]), row[2], row[3]
            kept, at, spans, removed = [], 0, 0, 0
            spread = [(0, len(text))] if copied else [(r["lo"], r["hi"]) for r in runs or ()]
            for lo, hi in sorted(spread):
                if lo > at or (lo == 0 and not spans):
                    spans += 1
                    kept.append(text[at:lo])
                    at = lo
                if hi > at:
                    removed += hi - at
                    at = hi
            kept.append(text[at:])
            rows.append((doc_id, len(text), removed, spans, b"".join(kept)))
        kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the remaining bytes)."""
    if length < GRAM + 8:
        raise ValueError(f"a string must have at least {GRAM + 8} bytes")
    spark = docs.sparkSession
    source = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "dk", "th", "text")
    texts = source.groupBy("th", F.octet_length("text").alias("n")).agg(F.min("dk").alias("dk"), F.max("dk").alias("most"))
    texts = stage(texts, "texts").where(F.col("n") >= length)
    packed = source.mapInArrow(_packed_texts, "doc_id long, dk long, th long, text binary")

    places = source.select("th", "text").mapInArrow(_anchor_rows(length), _ANCHORS)
    shared = places.groupBy("h").agg(F.min("anchor").alias("lo"), F.max("anchor").alias("hi")).where("lo < hi")
    places = places.select("h", "th", "p").join(shared.select("h"), "h", "left_semi").select("th", "p").distinct()
    places = places.groupBy("th").agg(F.collect_list("p").alias("places"))
    wanted = texts.select("th", "dk").join(places, "th")
    contexts = packed.join(wanted, ["dk", "th"]).select("th", "text", "places")
    contexts = stage(contexts.mapInArrow(_context_rows(length), _CONTEXTS), "contexts")

    # In suffix order, then by context: what is equal lies in one bucket but at its edges.
    suffix = F.expr("substring(context, p - first + 1)")
    buckets = contexts.repartitionByRange(partitions(spark), suffix, F.xxhash64("context"), "th", "p")
    found = stage(buckets.mapInArrow(_bucket(length), _COVERED), "covered")
    across = found.where(F.col("digest").isNotNull())
    both = across.groupBy("digest").agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).where("lo < hi")
    across = across.where("lo < hi").join(both.select("digest"), "digest", "left_semi")
    runs = found.where(F.col("digest").isNull()).unionByName(across).select("th", "lo", "hi").distinct()
    runs = runs.groupBy("th").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))

    # A text under several ids is removed as a whole; any other one is under the id of its class.
    copied = texts.where("dk < most").select("th", "n", F.lit(True).alias("copied"))
    copied = source.select("dk", "th", F.octet_length("text").alias("n")).join(copied, ["th", "n"])
    copied = copied.select("dk", "th", "copied", F.lit(None).cast("array<struct<lo:int,hi:int>>").alias("runs"))
    single = texts.where("dk = most").join(runs, "th").select("dk", "th", F.lit(False).alias("copied"), "runs")
    state = copied.dropDuplicates(["dk", "th"]).unionByName(single)
    rows = packed.join(state, ["dk", "th"], "left").select("doc_id", "text", "copied", "runs")
    return rows.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
