"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation, components.

A document is the set of its distinct shingles of `words` words (A-Z lower-cased; words are parted by ASCII white
space); with fewer words the whole sequence is its one shingle. Documents are linked if
100 * |intersection| >= per_hundred * |union|, and groups are the connected components of the links.

1. Documents of equal sets form one class; from here on a class is one node, whatever its number of copies.
2. Each of 24 bands of 5 minima is a bucket. Two sets of similarity 0.85 share no bucket with a probability of
   8e-7, of 0.8 with 8e-5.
3. The least node of a bucket is its hub, and every other node is a candidate with it.
4. A candidate pair's minima are compared in batches of 24. After each batch the posterior probability (uniform
   prior) that the similarity reaches the threshold is bounded by the number of equal minima; below `miss` the
   pair is dropped. Survivors are confirmed on their full sets, and components formed.
5. In buckets that still hold several components, the nodes outside the commonest one are tried with PARTNERS
   nodes of it, other ones in each of STRAY_ROUNDS rounds; this only joins early what belongs together.
6. All nodes that then share a bucket and are in different components are candidates too. They are compared
   block by block and confirmed in the same task, so that only links become rows; pairs within a component need no test. So no pair that shares a bucket remains open, yet a
   large group costs a few pairs for each member, not all its pairs.

Shingles are compared by 64-bit hashes, and a node is named by 64 bits of a hash of its set.

Null and empty texts and texts without words have no shingles and are linked with nothing: component_id is
their own doc_id. Repeated rows are copies. A null doc_id is never a component_id unless its group has no other.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlend.llm.common import keyed, lean, stage
from airlend.llm.components import components

WORDS = 5
PER_HUNDRED = 80
BANDS, ROWS, BATCH = 24, 5, 24
HASHES = BANDS * ROWS
STRAY_ROUNDS, PARTNERS = 2, 3
#: Nodes of a bucket that are compared in one task.
BLOCK = 256
#: Probability at which a pair that reaches the threshold may be dropped by one comparison of batches.
MISS = 1e-4
#: Bytes of text handled at once.
SLICE_BYTES = 4_000_000

_SKETCH = "doc_id long, dk long, th long, n_shingles long, key binary, node long, sig binary, shingles binary"
_ODD = np.random.default_rng(11).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    # Taken anew: list_value_length and flatten can disagree on what is split from an array with an offset.
    texts = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.list_value_length(parts).to_numpy().astype("i8")
    of = np.repeat(np.arange(len(texts)), sizes)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    of, coded = of[full], flat.filter(pa.array(full)).dictionary_encode()
    known = [xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()]
    hashes = np.array(known, np.uint64)[coded.indices.to_numpy()]
    count = np.bincount(of, minlength=len(texts))
    first = np.cumsum(count) - count
    rows = max(len(hashes) - words + 1, 0)
    joined = hashes[:rows].copy()
    for k in range(1, words):
        joined = _mixed(joined) + hashes[k : k + rows]
    joined = _mixed(joined)
    sets = []
    for begin, n in zip(first.tolist(), count.tolist()):
        if n >= words:
            sets.append(np.unique(joined[begin : begin + n - words + 1]))
        elif n:
            one = xxhash.xxh64_intdigest(hashes[begin : begin + n].tobytes(), seed=n)
            sets.append(np.array([one], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima of each non-empty set, as unsigned 32-bit numbers."""
    out = np.zeros((len(sets), HASHES), "<u4")
    full = [k for k, s in enumerate(sets) if len(s)]
    if full:
        values = np.concatenate([sets[k] for k in full])
        begins = np.cumsum([0] + [len(sets[k]) for k in full[:-1]])
        for k in range(HASHES):
            out[full, k] = np.minimum.reduceat((values * _ODD[k]) >> np.uint64(32), begins)
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy().astype("i8"))
    at = 0
    while at < len(batch):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def _sketches(words: int, whole: bool):
    """Rows of _SKETCH from (doc_id, dk, th, text): with the signature, or with the whole set."""
    names = [c.split()[0] for c in _SKETCH.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                sets = shingle_sets(part["text"], words)
                keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                nodes = np.frombuffer(b"".join(k[:8] for k in keys), "<i8")
                sigs = [None] * len(sets) if whole else [s.tobytes() for s in signatures(sets)]
                shown = [s.tobytes() for s in sets] if whole else [None] * len(sets)
                columns = [
                    part["doc_id"],
                    part["dk"],
                    part["th"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(nodes),
                    pa.array(sigs, pa.binary()),
                    pa.array(shown, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        minima = np.frombuffer(b"".join(batch["sig"].to_pylist()), "<u4").reshape(-1, BANDS, ROWS)
        found = np.tile(_mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(minima), 1))
        for k in range(ROWS):
            found = _mixed(found + minima[:, :, k].astype(np.uint64))
        nodes = np.repeat(batch["node"].to_numpy(), BANDS)
        bands = np.tile(np.arange(BANDS, dtype="i4"), len(minima))
        columns = [pa.array(found.view("i8").ravel()), pa.array(bands), pa.array(nodes)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "band", "node"])


def least_equal(per_hundred: int, miss: float = MISS) -> list[int]:
    """After each batch: how many equal minima a pair needs to go on.

    With m of n equal and a uniform prior the similarity is Beta(m + 1, n - m + 1) distributed; the chance that
    it is t or more is that of at most m successes in n + 1 trials of probability t.
    """
    t, least = per_hundred / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, 0
        while True:
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                break
            m += 1
        least.append(m)
    return least


def _alive(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Rows of signatures that are not pruned when they are compared batch by batch."""
    alive, equal = np.arange(len(left)), np.zeros(len(left), int)
    for k, needed in enumerate(least):
        # A batch takes a minimum of each band, so that none is one band.
        at = np.arange(k, HASHES, HASHES // BATCH)
        equal[alive] += (left[alive][:, at] == right[alive][:, at]).sum(axis=1)
        alive = alive[equal[alive] >= needed]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


def _not_pruned(least: list[int]):
    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = _alive(_signatures(batch["sig_a"]), _signatures(batch["sig_b"]), least)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return survivors


def _similar(left: np.ndarray, right: np.ndarray, per_hundred: int) -> bool:
    """Of two sorted sets."""
    common = int((left[np.minimum(np.searchsorted(left, right), len(left) - 1)] == right).sum())
    return 100 * common >= per_hundred * (len(left) + len(right) - common)


def _across(least: list[int], per_hundred: int):
    def links(table: pa.Table) -> pa.Table:
        """Links of two blocks of a bucket (or within one) whose labels differ, each in the first bucket it shares."""
        table = table.combine_chunks()
        block, node, label = (table[c].to_numpy() for c in ("block", "node", "label"))
        sigs, sets = _signatures(table["sig"]), [np.frombuffer(x.as_buffer(), "<u8") for x in table["shingles"]]
        one = np.flatnonzero(block == table["i"][0].as_py())
        other = np.flatnonzero(block == table["j"][0].as_py())
        pairs = [np.empty((0, 2), "i8")]
        for k in one.tolist():
            rest = other[(label[other] != label[k]) & ((node[other] > node[k]) | (block[other] != block[k]))]
            rest = rest[_alive(np.broadcast_to(sigs[k], (len(rest), HASHES)), sigs[rest], least)]
            equal = (sigs[rest] == sigs[k]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
            rest = rest[equal == table["band"][0].as_py()]
            rest = rest[[_similar(sets[k], sets[x], per_hundred) for x in rest.tolist()]] if len(rest) else rest
            pairs.append(np.stack([np.minimum(node[k], node[rest]), np.maximum(node[k], node[rest])], axis=1))
        found = np.concatenate(pairs)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return links


def _confirmed(per_hundred: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for k, (a, b) in enumerate(zip(batch["set_a"], batch["set_b"])):
                left, right = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                if _similar(left, right, per_hundred):
                    kept.append(k)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return links


def near_duplicates(docs: DataFrame, words: int = WORDS, per_hundred: int = PER_HUNDRED) -> DataFrame:
    """doc_id, dk, th (the document's key), n_shingles, label, component_id, kept: one row for each row of docs.

    label names the group (null without words); unlike component_id, its least doc_id, it is never null for two
    groups or equal where one doc_id stands on rows of two groups.
    """
    source = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "dk", "th", "text")
    sketches = stage(source.mapInArrow(lean(_sketches(words, False)), _SKETCH).drop("shingles"), "sketches")
    full = sketches.where("n_shingles > 0")
    of_doc = ["doc_id", "dk", "th"]
    classes = full.groupBy("key", "node").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("dk", "th")).alias("one"), F.first("sig").alias("sig")
    )
    classes = stage(classes, "classes")

    buckets = classes.select("node", "sig").mapInArrow(lean(_buckets), "bucket long, band int, node long")
    hubs = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    crowded = stage(buckets.join(hubs.drop("n"), "bucket"), "crowded")
    # The sets of all nodes that share a bucket, made once.
    wanted = classes.join(crowded.select("node").distinct(), "node", "left_semi").select("one.dk", "one.th")
    texts = source.join(wanted, ["dk", "th"], "left_semi").dropDuplicates(["dk", "th"])
    sets = texts.select(*of_doc, "text").mapInArrow(lean(_sketches(words, True)), _SKETCH).select("node", "shingles")
    sets = stage(sets, "sets")

    sigs, least = classes.select("node", "sig"), least_equal(per_hundred)

    def surviving(pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")
        return pairs.mapInArrow(lean(_not_pruned(least)), "a long, b long")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of the surviving pairs (a, b) those that are links."""
        pairs = stage(pairs, "survivors")
        pairs = pairs.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
        return stage(pairs.mapInArrow(lean(_confirmed(per_hundred)), "a long, b long"), "links")

    def mixed(links: DataFrame) -> DataFrame:
        """bucket, node, label, main (the commonest label) of the buckets that hold several components."""
        placed = crowded.drop("hub").join(components(links), "node", "left")
        placed = stage(placed.withColumn("label", F.coalesce("label", "node")), "placed")
        shared = placed.groupBy("bucket").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.mode("label", deterministic=True).alias("main")
        )
        return stage(placed.join(shared.where("lo < hi").select("bucket", "main"), "bucket"), "mixed")

    stars = crowded.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = linked(surviving(stars))
    for turn in range(STRAY_ROUNDS):
        open_buckets = mixed(links)
        if open_buckets.isEmpty():
            break
        chosen = [F.min_by("node", F.xxhash64("node", F.lit(turn), F.lit(k))) for k in range(PARTNERS)]
        partners = open_buckets.where("label = main").groupBy("bucket").agg(F.array_distinct(F.array(*chosen)).alias("a"))
        strays = open_buckets.where("label != main").join(partners, "bucket")
        tried = strays.select(F.explode("a").alias("a"), F.col("node").alias("b")).distinct()
        links = stage(links.unionByName(linked(surviving(tried))), "links")
    open_buckets = mixed(links)
    sizes = open_buckets.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = open_buckets.join(sizes, "bucket").join(sigs, "node").join(sets, "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")})
    rows = rows.select("bucket", "band", "i", "j", "block", "node", "label", "sig", "shingles")
    across = rows.groupBy("bucket", "i", "j").applyInArrow(_across(least, per_hundred), "a long, b long")
    labels = components(links.unionByName(stage(across, "links")))

    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    by_label = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(by_label, "label").select("key", "label", "component_id")
    found = sketches.drop("sig", "node").join(named, "key", "left")
    found = found.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select(*of_doc, "n_shingles", "label", "component_id", kept.alias("kept"))
