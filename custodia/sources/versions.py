"""Versioned tables as immutable data folders plus one history row per version.

A version is a list of data folders, so append and restore never copy old data,
and a reader of version n is not disturbed by a writer of version n+1.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed format of a history row.
HISTORY_SCHEMA = (
    "version long, committed_at string, operation string, folders array<string>, "
    "num_rows long, num_files long, num_bytes long, restored_from long"
)


class VersionedTable:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _commits(self) -> DataFrame:
        return self.spark.read.schema(HISTORY_SCHEMA).json(f"{self.base}/history/*")

    def _entry(self, version: int | None):
        """One history row (at most one per version, read on the driver)."""
        log = self._commits()
        if version is not None:
            log = log.filter(F.col("version") == version)
        rows = log.orderBy(F.desc("version")).limit(1).collect()
        if not rows:
            raise ValueError(f"version {version} not found in {self.base}")
        return rows[0]

    def current_version(self) -> int:
        return self._entry(None)["version"]

    def _commit(self, version, folders, operation, at, restored_from=None) -> int:
        row = self._files(folders).select(
            F.lit(version).cast("long").alias("version"),
            F.lit(at).alias("committed_at"),
            F.lit(operation).alias("operation"),
            F.array(*[F.lit(f) for f in folders]).alias("folders"),
            "num_rows",
            "num_files",
            "num_bytes",
            F.lit(restored_from).cast("long").alias("restored_from"),
        )
        # errorifexists: the second of two writers of the same version fails.
        row.coalesce(1).write.mode("errorifexists").json(f"{self.base}/history/{version:012d}")
        return version

    def _files(self, folders) -> DataFrame:
        """One row: rows, files and bytes of a version, from file metadata without reading columns."""
        meta = self.spark.read.parquet(*folders).select(
            F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")
        )
        per_file = meta.groupBy("p", "s").agg(F.count("*").alias("n"))
        return per_file.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
            F.count("*").alias("num_files"),
            F.coalesce(F.sum("s"), F.lit(0)).alias("num_bytes"),
        )

    def _new_folder(self, df: DataFrame) -> str:
        folder = f"{self.base}/data/{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(folder)
        return folder

    def create(self, df: DataFrame, at: str) -> int:
        return self._commit(0, [self._new_folder(df)], "CREATE", at)

    def overwrite(self, df: DataFrame, at: str) -> int:
        """``df`` may read this table: it is written to a new folder before the commit."""
        last = self.current_version()
        return self._commit(last + 1, [self._new_folder(df)], "OVERWRITE", at)

    def append(self, df: DataFrame, at: str) -> int:
        last = self._entry(None)
        folders = [*last["folders"], self._new_folder(df)]
        return self._commit(last["version"] + 1, folders, "APPEND", at)

    def restore(self, version: int, at: str) -> int:
        """Make an old version (schema included) the newest one; nothing is deleted."""
        old = self._entry(version)
        last = self.current_version()
        return self._commit(last + 1, list(old["folders"]), "RESTORE", at, restored_from=version)

    def read(self, version: int | None = None) -> DataFrame:
        folders = self._entry(version)["folders"]
        return self.spark.read.option("mergeSchema", len(folders) > 1).parquet(*folders)

    def history(self) -> DataFrame:
        return self._commits().select(
            "version", "committed_at", "operation", "num_rows", "num_files", "num_bytes", "restored_from"
        )
