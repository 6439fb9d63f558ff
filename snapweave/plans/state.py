"""Tables that change together, in versions: a manifest, written last, says which one holds.

Every version has a folder of its own.  A run that fails before its manifest is written leaves the
version before it in force, whole; a reader never sees tables of two versions.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from snapweave.session import remove

_MANIFEST = "version long, folder string, tables array<string>"


class Versions:
    """Versioned tables below a folder that all executors can reach; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path.rstrip("/")

    def _rows(self) -> list:
        try:
            found = self._spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(found, key=lambda row: row["version"])

    @property
    def version(self) -> int:
        """The version in force; 0 before the first."""
        rows = self._rows()
        return rows[-1]["version"] if rows else 0

    def read(self, table: str) -> DataFrame | None:
        """A table of the version in force; None if it has no such table."""
        rows = self._rows()
        if not rows or table not in rows[-1]["tables"]:
            return None
        return self._spark.read.parquet(f"{self.path}/{rows[-1]['folder']}/{table}")

    def commit(self, tables: Mapping[str, DataFrame]) -> int:
        """Write all tables as a new version and put it in force; the one before it stays on disk."""
        rows = self._rows()
        version = rows[-1]["version"] + 1 if rows else 1
        folder = f"v{version}-{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{self.path}/{folder}/{name}")
        row = self._spark.createDataFrame([(version, folder, list(tables))], _MANIFEST)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        for old in rows[:-1]:
            remove(self._spark, f"{self.path}/{old['folder']}")
        return version
