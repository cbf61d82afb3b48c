"""What the operators of this subpackage share: staging, row keys, dense order."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_FOLDER = "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a session on one machine that names none gets LOCAL_FOLDER."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = LOCAL_FOLDER
    return folder.rstrip("/")


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, kept when executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """How many partitions explicit repartitionings use: as many as shuffles have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), dk and th: the key of a document, its id (null: the least long) and a hash of its text.

    Rows that repeat both doc_id and text are one document and share one result.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(-(2**63)))
    rows = docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"), key.alias("dk"))
    return rows.withColumn("th", F.xxhash64("text"))


def with_keys(docs: DataFrame) -> DataFrame:
    """dk, th and all columns of the documents as one struct `row`, so that none can clash with an own one."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    key = F.coalesce(F.col("row.doc_id").cast("long"), F.lit(-(2**63))).alias("dk")
    th = F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("th")
    return rows.select(key, th, "row")


def unpacked(rows: DataFrame, **columns: Column) -> DataFrame:
    """The columns of `row`, some replaced or added."""
    names = [f.name for f in rows.schema["row"].dataType.fields]
    old = [columns[n].alias(n) if n in columns else F.col("row")[n].alias(n) for n in names]
    return rows.select(*old, *[c.alias(n) for n, c in columns.items() if n not in names])


def dense_order(df: DataFrame, *by: str) -> DataFrame:
    """Adds `pos`: 0, 1, 2, ... in the order of the columns `by`, without bringing the rows to one task.

    The rows are range-sorted and staged with their place in their range; the counts of the ranges, one row
    for each partition, give the first place of each range.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
    ranged = ranged.withColumn("_at", F.monotonically_increasing_id())
    ranged = stage(ranged.withColumn("_range", F.shiftright("_at", 33).cast("int")), "ordered")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    firsts = {}
    total = 0
    for row in sorted(sizes.collect()):  # one row for each partition
        firsts[row["_range"]] = total
        total += row["_n"]
    table = spark.createDataFrame(list(firsts.items()), "_range int, _first long")
    placed = ranged.join(F.broadcast(table), "_range")
    within = F.col("_at") - F.shiftleft(F.col("_range").cast("long"), 33)
    return placed.withColumn("pos", F.col("_first") + within).drop("_range", "_at", "_first")


def kept(name: str, make: Callable[[], object]) -> object:
    """What a worker keeps under this name from task to task, until a task of `lean` work ends."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def give_back() -> None:
    """Give the worker's free memory back to the machine: Arrow's and the C library's, if it can."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`work` for mapInArrow that leaves a reused worker small, whatever it and earlier tasks held.

    Workers wait idle beside the executor's own memory while later stages run, so what they keep counts there.
    """

    def lean_work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return lean_work


_KEPT: dict[str, object] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless they are started where they find it."""
    root = Path(__file__).resolve().parents[2]
    found = {str(Path(p).resolve()) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(root) in found | {os.path.realpath(os.getcwd())} or spark.sparkContext.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp()).resolve() / "airlend_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in (root / "airlend").rglob("*.py"):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


_SHIPPED: set[str] = set()
