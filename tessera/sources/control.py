"""A small versioned control table with compare-and-swap: the one place where readers learn what is
current. A version is a JSON file made complete beside its place and then given its name; of two
writers that start from one version the second fails and leaves nothing."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.files import Files


class StaleVersion(RuntimeError):
    """Someone else has committed since the version that was read."""


class ControlTable:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.path, self.schema, self._files = path.rstrip("/"), schema, Files(spark)

    def version(self) -> int:
        return max((int(n[1:-5]) for n in self._files.names(self.path) if n.startswith("v") and n.endswith(".json")), default=0)

    def rows(self, version: int | None = None) -> list[dict]:
        version = self.version() if version is None else version
        return json.loads(self._files.read_text(f"{self.path}/v{version}.json")) if version else []

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        names = [c.split()[0] for c in self.schema.split(", ")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in self.rows(version)], self.schema)

    def commit(self, rows: list[dict], expected: int) -> int:
        """Make ``rows`` the version after ``expected``, or raise ``StaleVersion``."""
        if not self._files.write_new(f"{self.path}/v{expected + 1}.json", json.dumps(rows)):
            raise StaleVersion(f"version {expected + 1} exists")
        return expected + 1
