"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... segments; a segment's statistics are its mean m and its deviation d, the length of
the segment less its mean. For segments of n components the distance of two vectors is bounded by

    |q - x|^2  >=  sum over segments of  n (mq - mx)^2 + (dq - dx)^2

and, since |q - x|^2 = |q|^2 + |x|^2 - 2 q.x, their inner product by

    q.x  <=  sum over segments of  n mq mx + dq dx

Finer segments bound more closely. A query has a floor, the k-th best score met so far: pairs whose bound lies below
it, coarse to fine, can't be among its k best; the scores of those left are computed exactly.

1. The floors start as the k-th best score among some SEEDS vectors. They only save work: results do not depend on
   the choice, and whatever they leave open is searched.
2. Queries with the same best seed are put together in blocks of QUERY_BLOCK. A block is summarised by the least and
   greatest mean and the greatest deviation of each segment, and the least floor of its queries.
3. Every row goes to those blocks for which its bound against the summary reaches the block's floor. The rows of a
   block are dealt to slots of about ROW_BLOCK rows in turn, so that no task gets all rows of a block, and each slot
   gets a copy of the block's queries.
4. A slot takes its rows some at a time, bounds them coarse to fine for each query, and raises the floors as it goes.
5. The k best of each slot are put together by query.

Summaries of at most GROUP blocks are on the driver and sent to tasks at once; more blocks are searched group by
group, so what is broadcast has a fixed bound (SEEDS vectors, GROUP summaries).

Vectors are whole numbers of at most LIMIT, so scores are exact, whatever the order of addition. Bounds are computed in
double precision with a margin for rounding. Rows take no part if their id is null or their vector is null or of
another length than most (of equally frequent lengths the least). A zero vector takes part. An id that is queried more than
once is one query with its least vector; rows with a query's own id are not its candidates, others that repeat
an id, or id and vector, are candidates of their own. Ties go to the smaller id. A query with fewer candidates than k
gets all. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlend.llm.common import dense_order, stage
from airlend.llm.vectors import common_length, matrix

SEEDS = 1_024
QUERY_BLOCK = 2_048
ROW_BLOCK = 8_192
GROUP = 4_096
#: Segments by which rows are compared with whole blocks.
BLOCK_SEGMENTS = 16
#: How many queries and rows are compared at once.
QUERIES_AT_ONCE, ROWS_AT_ONCE = 256, 2_048
#: The least floor: everything reaches it.
NO_FLOOR = -(2**62)
#: Rounding of bounds, relative to the product of the vectors' lengths.
MARGIN = 1e-9

_FOUND = "query_id long, vec_id long, score long"


def levels(length: int) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 2, 4, ... up to two components a segment."""
    found = [1]
    while found[-1] * 4 <= length:
        found.append(found[-1] * 2)
    return found


def _edges(length: int, segments: int) -> np.ndarray:
    return np.arange(segments + 1) * length // segments


def statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The means, times the root of the number of components, and the deviations of all segments."""
    edges = _edges(vectors.shape[1], segments)
    size = np.diff(edges)
    mean = np.add.reduceat(vectors, edges[:-1], axis=1) / size
    rest = vectors - np.repeat(mean, size, axis=1)
    return mean * np.sqrt(size), np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products pair by pair, in 64-bit whole numbers."""
    return np.einsum("ij,ij->i", queries, rows)


def _margin(queries: np.ndarray, rows: np.ndarray) -> float:
    longest = [np.sqrt((x.astype(float) ** 2).sum(axis=1).max(initial=0)) for x in (queries, rows)]
    return MARGIN * longest[0] * longest[1]


class _Best:
    """The k best (score, id) of some queries so far."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.scores = np.full((len(floors), k), NO_FLOOR, np.int64)
        self.ids = np.full((len(floors), k), np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.floors)
        query = np.concatenate([np.repeat(np.arange(n), self.k), query])
        score, ids = np.concatenate([self.scores.ravel(), score]), np.concatenate([self.ids.ravel(), ids])
        order = np.lexsort((ids, -score, query))
        first = np.searchsorted(query[order], np.arange(n))
        best = order[(first[:, None] + np.arange(self.k))]
        self.scores, self.ids = score[best], ids[best]
        self.floors = np.maximum(self.floors, self.scores[:, -1])


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """query_id, vec_id and score of the k best rows of each query, and how many scores were computed."""
    out, computed = [], 0
    by_level = [(s, statistics(queries.astype(float), s), statistics(rows.astype(float), s)) for s in levels(rows.shape[1])]
    margin = _margin(queries, rows)
    for lo in range(0, len(queries), QUERIES_AT_ONCE):
        part = slice(lo, lo + QUERIES_AT_ONCE)
        best = _Best(floors[part], k)
        at, more = 0, 64  # few rows at first, to have floors for the others
        while at < len(rows):
            here = np.arange(at, min(at + more, len(rows)))
            pair = None
            for _, (mq, dq), (mx, dx) in by_level:
                if pair is None:
                    bound = mq[part] @ mx[here].T + dq[part] @ dx[here].T
                    query, row = np.nonzero(bound >= best.floors[:, None] - margin)
                    pair = query, here[row]
                    continue
                query, row = pair
                if len(query) * 8 > len(best.floors) * len(here):  # many are left: all at once
                    bound = (mq[part] @ mx[here].T + dq[part] @ dx[here].T)[query, row - here[0]]
                else:
                    bound = _scores(mq[part][query], mx[row]) + _scores(dq[part][query], dx[row])
                left = bound >= best.floors[query] - margin
                pair = query[left], row[left]
            at, more = at + more, min(2 * more, ROWS_AT_ONCE)
            query, row = pair
            other = query_ids[part][query] != ids[row]
            query, row = query[other], row[other]
            for some in range(0, len(query), 65_536):
                q, r = query[some : some + 65_536], row[some : some + 65_536]
                score = _scores(queries[part][q], rows[r])
                computed += len(q)
                high = score >= best.floors[q]
                best.add(q[high], score[high], ids[r[high]])
        query, place = np.nonzero(best.scores > NO_FLOOR)
        out.append((query_ids[part][query], best.ids[query, place], best.scores[query, place]))
    found = [np.concatenate(column) if out else np.zeros(0, np.int64) for column in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return *found, computed


def usable(vectors: DataFrame) -> DataFrame:
    """The rows (id, v: array<int>) of the commonest length, staged: they are read several times."""
    vectors = stage(vectors.where(F.col("id").isNotNull() & F.col("v").isNotNull()).select("id", "v"), "vectors")
    length = common_length(vectors)
    return vectors.where(F.size("v") == (length if length is not None else -1))


def _seeds(vectors: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """About SEEDS vectors, chosen by a hash of id and vector: at most four times as many, from any tasks."""
    every = max(vectors.count() // SEEDS, 1)
    chosen = vectors.where(F.pmod(F.xxhash64("id", "v"), F.lit(every)) == 0).limit(4 * SEEDS).collect()
    ids = np.array([row["id"] for row in chosen], np.int64)
    return ids, np.array([row["v"] for row in chosen], np.int64).reshape(len(chosen), length)


def _with_floors(queries: DataFrame, seeds: tuple[np.ndarray, np.ndarray], length: int, k: int) -> DataFrame:
    """id, v, seed (the best one), floor and the segment statistics means and deviations."""
    shared = queries.sparkSession.sparkContext.broadcast(seeds)
    segments = min(BLOCK_SEGMENTS, levels(length)[-1])

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seed_rows = shared.value
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                own, v = batch["id"].to_numpy(), matrix(batch["v"], length)
                score = np.where(own[:, None] == ids, NO_FLOOR, v @ seed_rows.T)
                order = np.argsort(-score, axis=1, kind="stable")
                floor = np.full(len(v), NO_FLOOR)
                if score.shape[1] >= k:
                    floor = np.take_along_axis(score, order[:, k - 1 : k], 1)[:, 0]
                seed = order[:, 0] if order.shape[1] else np.zeros(len(v), np.int64)
                means, deviations = statistics(v.astype(float), segments)
                columns = [batch["id"], batch["v"], pa.array(seed.astype("i4")), pa.array(floor)]
                columns += [pa.array(list(means)), pa.array(list(deviations))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "seed", "floor", "means", "deviations"])

    schema = "id long, v array<int>, seed int, floor long, means array<double>, deviations array<double>"
    return queries.mapInArrow(floors, schema)


class _Blocks:
    """Summaries of some blocks of queries, and which rows they have to look at."""

    def __init__(self, rows: list, length: int):
        self.blocks = np.array([row["block"] for row in rows], np.int32)
        self.floors = np.array([row["floor"] for row in rows], float)
        low, high, deviation = (np.array([row[name] for row in rows], float) for name in ("low", "high", "deviation"))
        # max(m * low, m * high) = max(m, 0) * high + max(-m, 0) * -low, so that a product of matrices bounds all pairs.
        self.weights = np.hstack([high, -low, deviation]).T
        self.segments, self.length = low.shape[1], length
        ends = np.maximum(np.abs(low), np.abs(high))
        self.reach = np.sqrt((ends**2 + deviation**2).sum(axis=1))

    def wanted(self, rows: np.ndarray) -> np.ndarray:
        """Which of the blocks (columns) each row has to go to."""
        means, deviations = statistics(rows.astype(float), self.segments)
        bound = np.hstack([np.maximum(means, 0), np.maximum(-means, 0), deviations]) @ self.weights
        size = np.sqrt((means**2 + deviations**2).sum(axis=1))
        return bound >= self.floors - MARGIN * size[:, None] * self.reach


def _searched(vectors: DataFrame, queries: DataFrame, blocks: _Blocks, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each query of these blocks in each slot of rows."""
    spark = vectors.sparkSession
    shared, length = spark.sparkContext.broadcast(blocks), blocks.length

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(shared.value.blocks), np.int64)
        for whole in batches:
            for at in range(0, len(whole), 1024):
                n += shared.value.wanted(matrix(whole.column(0).slice(at, 1024), length)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(shared.value.blocks), pa.array(n)], names=["block", "n"])

    # One row for each block of the group.
    sizes = vectors.select("v").mapInArrow(counted, "block int, n long").groupBy("block").agg(F.sum("n").alias("n"))
    slots = {row["block"]: -(-row["n"] // ROW_BLOCK) for row in sizes.collect() if row["n"]}
    dealt = spark.sparkContext.broadcast(np.array([max(slots.get(block, 0), 1) for block in blocks.blocks.tolist()]))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = dealt.value * 0
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                wanted = shared.value.wanted(matrix(batch["v"], length))
                for block in np.flatnonzero(wanted.any(axis=0)):
                    taken = batch.take(pa.array(np.flatnonzero(wanted[:, block])))
                    # Partitions start at different slots: the first id decides.
                    if not turn[block]:
                        turn[block] = abs(hash(taken["id"][0].as_py())) % dealt.value[block]
                    slot = (turn[block] + np.arange(len(taken))) % dealt.value[block]
                    turn[block] += len(taken)
                    same = np.full(len(taken), shared.value.blocks[block], "i4")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(same), pa.array(slot.astype("i4")), *taken.columns], names=["block", "slot", "id", "v"]
                    )

    rows = vectors.select("id", "v").mapInArrow(routed, "block int, slot int, id long, v array<int>")
    table = F.broadcast(spark.createDataFrame(list(slots.items()), "block int, slots int"))
    copies = queries.join(table, "block").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    copies = copies.select("block", "slot", "id", "v", "floor")

    def best(asked: pa.Table, found: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not len(asked) or not len(found):
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        ids, floors = asked["id"].to_numpy(), asked["floor"].to_numpy()
        rows = matrix(found["v"], length)
        *columns, _ = search_block(ids, matrix(asked["v"], length), floors, found["id"].to_numpy(), rows, k)
        return pa.table(list(map(pa.array, columns)), names=names)

    return copies.groupBy("block", "slot").cogroup(rows.groupBy("block", "slot")).applyInArrow(best, _FOUND)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for `queries` among `vectors` (both from `usable`)."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    length = common_length(vectors)
    if length is None:
        return empty
    queries = queries.where(F.size("v") == length).groupBy("id").agg(F.min("v").alias("v"))
    known = _with_floors(queries, _seeds(vectors, length), length, k)
    known = dense_order(known, "seed", "id").withColumn("block", F.floor(F.col("pos") / QUERY_BLOCK).cast("int"))
    segments = min(BLOCK_SEGMENTS, levels(length)[-1])

    def ends(how, column: str, name: str):
        return F.array(*[how(F.col(column)[s]) for s in range(segments)]).alias(name)

    summaries = known.groupBy("block").agg(
        ends(F.min, "means", "low"),
        ends(F.max, "means", "high"),
        ends(F.max, "deviations", "deviation"),
        F.min("floor").alias("floor"),
    )
    summaries = stage(summaries, "query-blocks")
    found, first = None, 0
    n_blocks = summaries.count()
    while first < n_blocks:
        inside = F.col("block").between(first, first + GROUP - 1)
        group = _Blocks(summaries.where(inside).orderBy("block").collect(), length)
        some = _searched(vectors, known.where(inside), group, k)
        found = some if found is None else found.unionByName(some)
        first += GROUP
    if found is None:
        return empty
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
