"""Keyed rows in storage that are upserted: copy on write, one part of the keys at a time.

A key's hash names its part. An upsert reads only the parts that the incoming keys fall into, writes these
anew beside the old ones, and then points the table's list of files at the new folders in one catalog
call. Other parts keep their files; a reader sees the list from before or after, never half of it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from .layout import replace_table

_EMPTY = -1  # the part of an empty file that keeps the columns


class VersionedTable:
    """``name``: the catalog table that lists the parts and their folders, one row per part."""

    def __init__(self, spark: SparkSession, name: str, key: list[str], parts: int):
        self.spark, self.name, self.key, self.parts = spark, name, key, parts

    @classmethod
    def create(cls, rows: DataFrame, name: str, key: list[str], parts: int) -> VersionedTable:
        """A new table of ``rows``. Of several rows with one key that with the largest other columns stays."""
        table = cls(rows.sparkSession, name, key, parts)
        folder = scratch_path(table.spark, name)
        rows.limit(0).coalesce(1).write.parquet(os.path.join(folder, "columns"))
        written = table._write(table._one_per_key(rows.withColumn("_new", F.lit(0))), folder)
        table._list([(_EMPTY, os.path.join(folder, "columns")), *written.items()])
        return table

    def files(self) -> dict[int, str]:
        """The folder of each part that has rows; at most ``parts`` and one more."""
        return {r["part"]: r["path"] for r in self.spark.table(self.name).collect()}

    def read(self) -> DataFrame:
        return self._rows(self.files())

    def upsert(self, incoming: DataFrame) -> list[int]:
        """Rows of known keys replaced, others added; returns the parts that were written anew.

        Several incoming rows with one key count as in ``create``. A null is a key like any other.
        """
        files = self.files()
        new = materialise(self._one_per_key(incoming.select(*self._columns(files)).withColumn("_new", F.lit(1))),
                          f"{self.name}-incoming")
        touched = sorted(r["_part"] for r in new.select("_part").distinct().collect())
        if not touched:
            return []
        old = self._rows({k: p for k, p in files.items() if k in touched or k == _EMPTY})
        merged = self._one_per_key(old.withColumn("_new", F.lit(0)).unionByName(
            new.drop("_part").withColumn("_new", F.lit(1))))
        written = self._write(merged, scratch_path(self.spark, self.name))
        self._list([*{**files, **written}.items()])
        return touched

    def _columns(self, files: dict[int, str]) -> list[str]:
        return self.spark.read.parquet(files[_EMPTY]).columns

    def _rows(self, files: dict[int, str]) -> DataFrame:
        schema = self.spark.read.parquet(files[_EMPTY]).schema
        return self.spark.read.schema(schema).parquet(*files.values())

    def _one_per_key(self, rows: DataFrame) -> DataFrame:
        """The latest row of each key, with its part: one aggregation, combined before the shuffle."""
        others = [c for c in rows.columns if c not in self.key and c != "_new"]
        best = F.max(F.struct("_new", *others)).alias("_best")
        return rows.groupBy(*self.key).agg(best).select(
            *[F.col(c) if c in self.key else F.col("_best")[c].alias(c) for c in rows.columns if c != "_new"],
            F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int").alias("_part"))

    def _write(self, rows: DataFrame, folder: str) -> dict[int, str]:
        path = os.path.join(folder, uuid.uuid4().hex)
        rows.hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
        found = self.spark.read.parquet(path).select("_part").distinct().collect() if rows.head(1) else []
        return {r["_part"]: os.path.join(path, f"_part={r['_part']}") for r in found}

    def _list(self, files: list[tuple[int, str]]) -> None:
        replace_table(self.spark.createDataFrame(files, "part int, path string").coalesce(1), self.name)
