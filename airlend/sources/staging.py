"""Intermediate tables that belong to a run: kept while it lasts, found again after a lost driver, removed at its end."""

from __future__ import annotations

import json
import re
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

from airlend.sources.tables import shared_folder


class Run:
    """The staged tables of one run, in a folder of their own in the shared folder.

        with Run(spark, "features-2022-08") as run:
            write_features(build_feature_table(loans, payments, recharges, cfg, run=run), path)

    A table is complete when Spark has committed it and its schema is written beside it. A run of the same name that
    starts again, after its driver was lost, reads complete tables instead of computing them; the name must
    therefore stand for the inputs as well. An incomplete table, or one of another schema, is written anew. The folder
    is removed when the block ends; after an error it stays for the next try, unless `keep_failed` is false.
    """

    def __init__(self, spark: SparkSession, name: str, keep_failed: bool = True) -> None:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name):
            raise ValueError(f"a run's name is made of letters, digits, '.', '_' and '-': {name!r}")
        self.spark, self.keep_failed = spark, keep_failed
        self.folder = f"{shared_folder(spark).rstrip('/')}/runs/{name}"
        self.reused: list[str] = []

    def __enter__(self) -> Run:
        return self

    def __exit__(
        self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        if kind is None or not self.keep_failed:
            self.remove()

    def _path(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _schema_of(self, path: str) -> str | None:
        """The schema written beside a committed table, or None."""
        system, committed = self._path(f"{path}/data/_SUCCESS")
        if not system.exists(committed) or not system.exists(self._path(f"{path}/schema/_SUCCESS")[1]):
            return None
        rows = self.spark.read.text(f"{path}/schema", wholetext=True).collect()
        return "".join(row["value"] for row in rows).strip()

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """`df`, written under this name of the run or found there, and read back."""
        path, schema = f"{self.folder}/{name}", df.schema.json()
        if self._schema_of(path) == schema:
            self.reused.append(name)
        else:
            df.write.mode("overwrite").parquet(f"{path}/data")
            text = self.spark.createDataFrame([(json.dumps(json.loads(schema), separators=(",", ":")),)], "value string")
            text.coalesce(1).write.mode("overwrite").text(f"{path}/schema")
        return self.spark.read.schema(df.schema).parquet(f"{path}/data")

    def tables(self) -> list[str]:
        """The names of the run's complete tables."""
        system, folder = self._path(self.folder)
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted(name for name in names if self._schema_of(f"{self.folder}/{name}"))

    def remove(self) -> None:
        system, folder = self._path(self.folder)
        system.delete(folder, True)
