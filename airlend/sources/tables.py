"""Delimited ledgers and parquet sources in, partitioned parquet out."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend.schemas import LEDGER_COLUMNS


def read_ledger(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Delimited text with a header (gzip or plain, one path, several or a glob), columns named by position.

    Without a schema every column is text, to be typed by `type_ledger`; nothing is inferred, so the files
    are read once. Gzip files are not splittable: many files give many tasks, one file gives one.
    """
    names = list(names or (schema.names if schema else LEDGER_COLUMNS))
    schema = schema or T.StructType([T.StructField(name, T.StringType()) for name in names])
    paths = [path] if isinstance(path, str) else list(path)
    # With a schema given the header line is only skipped, so the columns go by position.
    raw = spark.read.schema(schema).csv(paths, header=True, sep=",", enforceSchema=True)
    return raw.toDF(*names)


def read_sources(
    spark: SparkSession, advances: str, payments: str, recharges: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three parquet extracts, untouched."""
    return spark.read.parquet(advances), spark.read.parquet(payments), spark.read.parquet(recharges)


def write_features(df: DataFrame, path: str, partition_by: str = "loan_month", ts: str = "loan_ts") -> None:
    """Overwrite `path` with parquet, one folder per loan month.

    The rebalance hint lets Spark size the files: small months are merged into few files and a month that
    holds much of the data is split over many tasks.
    """
    months = df.withColumn(partition_by, F.date_format(ts, "yyyy-MM"))
    months.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share; an error if none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir, or setCheckpointDir, to a folder that all executors share")
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For a table that several branches of one plan use: it is computed once, each branch then reads only
    its columns and row groups, and lost executors cost no recomputation of what is below it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
