"""Vector code compression: vectors are cut into parts, each part is written as the index of its nearest entry in
the codebook of its place, found by Orchard search.

Every codebook keeps, for each entry, the other entries sorted by their distance from it. A search holds the best
entry so far and goes through that entry's list. An entry that is better makes the search jump to its list; entries
met before are marked and not compared again; the search ends at a list entry that lies more than twice as far from
the best entry as the vector does, since by the triangle inequality it and all later ones are farther from the vector.
An entry exactly twice as far may still be equally near, so it is compared, and the least index wins.

Components are whole numbers, floor(scale * x), so that distances, sums and codes are exact and the same in any order
of addition. Each round is one pass over the staged vectors: tasks assign parts and add them up, the sums of all
tasks (one row for each entry and component of a codebook) are put together by a shuffle, and only the codebooks,
parts * entries * components / parts numbers whatever the number of vectors, are on the driver and sent to tasks.

Vectors that are null or hold components that are null or not finite are dropped, as are those of another length
than most (of equally frequent lengths the least). Lengths that do not divide evenly have longer first parts; a part
without components has distance 0. Null ids are kept, come last in order and are coded like others. Rows that repeat
an id are rows of their own, in the order of their vectors. With fewer rows than entries a codebook has as many
entries as there are rows; an empty table gives an empty one. Components of more than LIMIT / scale raise an error.
Other columns are kept by `encode` as they are; `v`, `code` and `error` are its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend.llm.vectors import common_length, matrix

PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Sums by label have one row for each label; up to so many they are broadcast, beyond joined with salts.
BROADCAST_LABELS = 100_000
SALTS = 32

_SUMS = "part int, entry int, place int, n long, total long"


class Codebook:
    """The entries of one part (rows of whole numbers) with their neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        n = len(entries)
        order = np.argsort(between, axis=1, kind="stable")
        self.lists = order[order != np.arange(n)[:, None]].reshape(n, n - 1)
        self.far = np.take_along_axis(between, self.lists, axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry of each point, its squared distance, and how many distances were computed."""
        n = len(points)
        best, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
        least = ((points - self.entries[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, len(self.entries)), bool)
        seen[:, 0] = True
        compared, rows = n, np.arange(n)
        while len(rows):
            rows = rows[at[rows] < self.lists.shape[1]]
            rows = rows[self.far[best[rows], at[rows]] <= 4 * least[rows]]
            found = self.lists[best[rows], at[rows]]
            at[rows] += 1
            new = ~seen[rows, found]
            r, found = rows[new], found[new]
            seen[r, found] = True
            distance = ((points[r] - self.entries[found]) ** 2).sum(axis=1)
            compared += len(r)
            better = (distance < least[r]) | ((distance == least[r]) & (found < best[r]))
            r = r[better]
            best[r], least[r], at[r] = found[better], distance[better], 0
        return best, least, compared


class ProductCodes:
    """Codebooks for vectors of one length; `edges` are the places at which they are cut."""

    def __init__(self, length: int, parts: int, entries: list[np.ndarray]):
        self.length = length
        self.edges = np.cumsum([0, *(length // parts + (p < length % parts) for p in range(parts))])
        self.entries = entries

    @classmethod
    def fit(cls, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> ProductCodes:
        """Codebooks from `vectors` (id, v: array<int>), which should be a stored table: it is read once a round.

        They start as the parts of the `entries` least ids. A round assigns every part to its nearest entry and
        replaces each entry by the floor of its parts' mean; entries without parts stay.
        """
        length = common_length(vectors)
        if length is None:
            return cls(0, parts, [])
        usable = vectors.where(F.size("v") == length)
        first = usable.orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
        first = np.array([row["v"] for row in first], np.int64).reshape(len(first), length)
        codes = cls(length, parts, [])
        codes.entries = [first[:, lo:hi] for lo, hi in zip(codes.edges, codes.edges[1:])]
        for _ in range(rounds):
            codes.entries = codes._moved(usable)
        return codes

    def _moved(self, vectors: DataFrame) -> list[np.ndarray]:
        books, length, edges = [Codebook(e) for e in self.entries], self.length, self.edges

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = [np.zeros_like(book.entries) for book in books]
            counts = [np.zeros(len(book.entries), np.int64) for book in books]
            for batch in batches:
                points = matrix(batch.column(0), length)
                for p, book in enumerate(books):
                    part = points[:, edges[p] : edges[p + 1]]
                    nearest = book.nearest(part)[0]
                    np.add.at(totals[p], nearest, part)
                    counts[p] += np.bincount(nearest, minlength=len(counts[p]))
            for p, (total, n) in enumerate(zip(totals, counts)):
                entry, place = np.nonzero(np.broadcast_to(n[:, None] > 0, total.shape))
                columns = [np.full(len(entry), p, "i4"), entry.astype("i4"), place.astype("i4"), n[entry], total[entry, place]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["part", "entry", "place", "n", "total"])

        added = vectors.select("v").mapInArrow(sums, _SUMS).groupBy("part", "entry", "place")
        moved = [entries.copy() for entries in self.entries]
        # One row for each component of a codebook.
        for row in added.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            moved[row["part"]][row["entry"], row["place"]] = row["total"] // row["n"]
        return moved

    def encode(self, vectors: DataFrame) -> DataFrame:
        """The other columns of `vectors`, code (two hex digits a part) and error (squared distance to the entries)."""
        others = [field for field in vectors.schema if field.name not in ("v", "code", "error")]
        schema = T.StructType([*others, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
        if not self.entries:
            return vectors.sparkSession.createDataFrame([], schema)
        books, length, edges = [Codebook(e) for e in self.entries], self.length, self.edges
        digits = np.array([f"{k:02x}" for k in range(max(map(len, self.entries)))])
        names = [field.name for field in others]

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = matrix(batch["v"], length)
                code, error = np.full(len(points), "", object), np.zeros(len(points), np.int64)
                for p, book in enumerate(books):
                    nearest, distance, _ = book.nearest(points[:, edges[p] : edges[p + 1]])
                    code, error = code + digits[nearest].astype(object), error + distance
                columns = [*(batch[name] for name in names), pa.array(code, pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "code", "error"])

        return vectors.where(F.size("v") == length).select(*names, "v").mapInArrow(coded, schema)

    def decode(self, codes: DataFrame) -> DataFrame:
        """`codes` with v, the entries that the code names one after another, as whole numbers."""
        if not self.entries:
            return codes.withColumn("v", F.array().cast("array<int>"))
        books = F.array(*[F.array(*[F.array(*map(F.lit, e.tolist())) for e in entries]) for entries in self.entries])
        parts = F.sequence(F.lit(0), F.lit(len(self.entries) - 1))
        index = lambda p: F.conv(F.substring("code", 2 * p + 1, F.lit(2)), 16, 10).cast("int")
        chosen = F.flatten(F.transform(parts, lambda p: F.get(F.get(books, p), index(p))))
        return codes.withColumn("v", chosen.cast("array<int>"))

    def sha256(self) -> str:
        """Digest of all entries' components by part, entry and place, joined by commas."""
        numbers = [str(x) for entries in self.entries for x in entries.ravel().tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def with_label_error(codes: DataFrame, label: str = "label") -> DataFrame:
    """`codes`, a stored table, with label_error: the error of all rows of the same label, null labels together.

    A label may hold most of the rows, so rows meet the sums by broadcast or, with very many labels, by salts.
    """
    sums = codes.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    same = F.col(label).eqNullSafe(F.col("_label"))
    if codes.select(label).distinct().count() <= BROADCAST_LABELS:
        return codes.join(F.broadcast(sums), same).drop("_label")
    salted = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = codes.withColumn("_own", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return spread.join(salted, same & (F.col("_own") == F.col("_salt"))).drop("_label", "_salt", "_own")
