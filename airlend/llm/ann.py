"""Approximate nearest neighbours by learned partitions.

Fitting looks at up to SAMPLE vectors, those with the least hash of their id: their graph of GRAPH_NEIGHBOURS
nearest neighbours is cut into parts of equal size by repeated spectral bisection, and a softmax classifier
learns to tell a vector's part. Every vector is then indexed in its most probable part. A query is routed to its
most probable parts until they hold a mass of its probability, and its candidates there are reranked by cosine
in double precision. The mass is the least that finds FOUND of the sample's own neighbours: where vectors lie in
clusters it is small and few parts are looked at. Neighbours in the sample lie farther off than those among all
vectors, so the latter are found no less often. Parts are added for queries whose parts hold fewer than k others.
There is about one part for ROWS_PER_PART vectors.

Parts are dealt out in blocks of vectors and of queries, so that a part that holds very many equal vectors is
no larger a task than any other. `Index.search` returns the k best of each query, ties to the smaller id.

Vectors that are null, zero, without components or with null or non-finite ones take no part, nor do rows without
id, nor vectors of another length than most in the sample. An id that is queried more than once is one query with
its least vector; rows with a query's own id are not its candidates. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 8_192
GRAPH_NEIGHBOURS = 10
ROWS_PER_PART = 4_096
#: The share of the sample's neighbours that the parts looked at have to hold.
FOUND = 0.95
BLOCK = 4_096
QUERY_BLOCK = 1_024

_FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (array<double>) of the rows that take part."""
    rows = vectors.select(
        vectors[id_column].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v")
    )
    fault = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    return rows.where(~F.coalesce(fault, F.lit(True)) & F.exists("v", lambda x: x != 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(unit: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of each row, block by block."""
    k = min(k, len(unit) - 1)
    found = []
    for at in range(0, len(unit), 512):
        near = unit[at : at + 512] @ unit.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -2
        found.append(np.argpartition(-near, k - 1, axis=1)[:, :k] if k else np.zeros((len(near), 0), int))
    return np.concatenate(found)


def balanced_parts(near: np.ndarray, parts: int) -> np.ndarray:
    """Parts of equal size (to one) of the graph, by spectral bisection; parts is a power of two."""
    part = np.zeros(len(near), int)
    source, target = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
    rng = np.random.default_rng(5)
    while parts > 1:
        parts //= 2
        inside = part[source] == part[target]
        a, b = source[inside], target[inside]
        degree = np.bincount(a, minlength=len(near)) + np.bincount(b, minlength=len(near)) + 1.0
        size = np.bincount(part)
        x = rng.standard_normal(len(near))
        for _ in range(60):  # power iterations on the lazy random walk, all parts at once
            x -= (np.bincount(part, x * degree) / np.bincount(part, degree))[part]
            x /= np.sqrt(np.bincount(part, x * x) / size + 1e-300)[part]
            spread = np.bincount(a, x[b], len(near)) + np.bincount(b, x[a], len(near))
            x = (x + (spread + x) / degree) / 2
        order = np.lexsort((x, part))
        rank = np.empty(len(near), int)
        rank[order] = np.arange(len(near))
        rank -= (np.cumsum(size) - size)[part]
        part = 2 * part + (rank >= size[part] // 2)
    return part


def fit_classifier(unit: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    """Softmax weights (a row for each component and one for the constant), by Adam on all rows."""
    x = np.hstack([unit, np.ones((len(unit), 1))])
    weights, first, second = (np.zeros((x.shape[1], parts)) for _ in range(3))
    target = np.eye(parts)[part]
    for step in range(1, 301):
        p = _softmax(x @ weights)
        slope = x.T @ (p - target) / len(x) + 1e-4 * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return weights


def least_mass(unit: np.ndarray, near: np.ndarray, weights: np.ndarray, found: float, k: int = 5) -> float:
    """The least mass of probability at which the parts of a vector hold `found` of its k nearest."""
    p = _softmax(np.hstack([unit, np.ones((len(unit), 1))]) @ weights)
    cosines = np.stack([(unit[column] * unit).sum(axis=1) for column in near.T], axis=1)
    nearest = np.take_along_axis(near, np.argsort(-cosines, axis=1, kind="stable")[:, :k], 1)
    own = p.argmax(axis=1)[nearest]
    order = np.argsort(-p, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(p, order, 1), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(p.shape[1]), p.shape), 1)
    # A part is looked at if those before it hold less than the mass.
    sums = np.hstack([np.zeros((len(unit), 1)), sums])
    before = np.take_along_axis(sums, np.take_along_axis(rank, own, 1), 1)
    return float(np.nextafter(np.quantile(before, found, method="higher"), 2.0))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Index:
    """Fitted on `vectors` (id, v of `usable`)."""

    def __init__(self, vectors: DataFrame, rows_per_part: int = ROWS_PER_PART, found: float = FOUND):
        chosen = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).collect()
        lengths = pd.Series([len(row["v"]) for row in chosen], dtype=int)
        self.length = int(lengths.mode().min()) if len(lengths) else 0
        sample = np.array([row["v"] for row in chosen if len(row["v"]) == self.length], float)
        self.vectors = vectors.where(F.size("v") == self.length)
        rows = self.vectors.count()
        parts = 1
        while parts * rows_per_part < rows and parts * 16 <= len(sample):
            parts *= 2
        self.weights = np.zeros((self.length + 1, parts))
        self.mass = 1.0
        if parts > 1:
            unit = _unit(sample)
            near = neighbour_graph(unit, GRAPH_NEIGHBOURS)
            self.weights = fit_classifier(unit, balanced_parts(near, parts), parts)
            self.mass = least_mass(unit, near, self.weights, found)

    def routed(self, vectors: DataFrame, sizes: np.ndarray | None = None, least: int = 0) -> DataFrame:
        """id, v, part: the most probable part, or, given the sizes of the parts, a row for each part that a query
        looks at: so many that they hold the mass and at least `least` vectors."""
        shared = vectors.sparkSession.sparkContext.broadcast((self.weights, sizes))
        length, mass = self.length, 0.0 if sizes is None else self.mass

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                unit = _unit(batch["v"].flatten().to_numpy().reshape(-1, length))
                weights, sizes = shared.value
                p = _softmax(np.hstack([unit, np.ones((len(unit), 1))]) @ weights)
                order = np.argsort(-p, axis=1, kind="stable")
                before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
                before[:, 0] = -1
                wanted = before < mass
                if sizes is not None:
                    wanted |= np.cumsum(sizes[order], axis=1) - sizes[order] < least
                row, rank = np.nonzero(wanted)
                taken = batch.take(pa.array(row))
                columns = [*taken.columns, pa.array(order[row, rank].astype("i4"))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "part"])

        return vectors.select("id", "v").mapInArrow(parts, "id long, v array<double>, part int")

    def search(self, queries: DataFrame, k: int = 5) -> DataFrame:
        """query_id, rank (from 1), vec_id, score for `queries` (id, v of `usable`)."""
        queries = queries.where(F.size("v") == self.length).groupBy("id").agg(F.min("v").alias("v"))
        placed = self.routed(self.vectors)

        # One row for each part.
        def counts(rows: DataFrame, size: int) -> dict[int, int]:
            return {row["part"]: -(-row["count"] // size) for row in rows.groupBy("part").count().collect()}

        sizes = np.zeros(self.weights.shape[1], int)
        for part, n in counts(placed, 1).items():
            sizes[part] = n
        # Rows with an id that stands on many are no candidates of its query, so the largest such group counts as well.
        repeated = self.vectors.groupBy("id").count().agg(F.max("count")).first()[0] or 0
        asked = self.routed(queries, sizes, k + repeated)
        blocks, query_blocks = {part: -(-int(n) // BLOCK) for part, n in enumerate(sizes) if n}, counts(asked, QUERY_BLOCK)
        table = [(part, n, query_blocks[part]) for part, n in blocks.items() if part in query_blocks]

        def blocked() -> DataFrame:
            spark = queries.sparkSession
            return F.broadcast(spark.createDataFrame(table, "part int, blocks int, query_blocks int"))

        own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        placed = placed.join(blocked(), "part").withColumn("block", own("blocks"))
        placed = placed.withColumn("query_block", every("query_blocks"))
        asked = asked.join(blocked(), "part").withColumn("query_block", own("query_blocks"))
        asked = asked.withColumn("block", every("blocks"))
        keys = ["part", "block", "query_block"]

        def best(query_rows: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(query_rows) or not len(rows):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            rows = rows.sort_values("id")
            ids, vectors = rows["id"].to_numpy(), np.vstack(rows["v"].to_numpy())
            lengths = np.sqrt((vectors * vectors).sum(axis=1))
            unit = vectors / lengths[:, None]
            out = []
            for at in range(0, len(query_rows), 256):
                part = query_rows.iloc[at : at + 256]
                asked = np.vstack(part["v"].to_numpy())
                near = asked @ unit.T / np.sqrt((asked * asked).sum(axis=1))[:, None]
                for query, v, row in zip(part["id"].to_numpy(), asked, near):
                    row[ids == query] = -np.inf
                    least = np.partition(row, -min(k, len(row)))[-min(k, len(row))]
                    close = np.flatnonzero((row >= least - 1e-9) & (row > -np.inf))
                    # Equal vectors get equal scores here, whatever blocks the product above was made in.
                    exact = (vectors[close] * v).sum(axis=1) / (lengths[close] * np.sqrt((v * v).sum()))
                    order = np.lexsort((ids[close], -exact))[:k]
                    out.append(pd.DataFrame({"query_id": query, "vec_id": ids[close][order], "score": exact[order]}))
            return pd.concat(out)

        found = asked.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInPandas(best, _FOUND)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
