"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.files import Files

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "tessera", master: str | None = None, partitions: int = 8) -> SparkSession:
    """A session with the settings the operators are written for; a running session is reused."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may lack the setting (tests, a laptop): it gets a folder of its own, which is
    removed when the interpreter ends. On a cluster a folder of one machine would not do, so there the
    missing setting is an error.
    """
    named = spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tessera-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return _own[0]


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tessera/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table written by ``cut``; quiet when it is already gone."""
    Files(spark).delete(path)


def cut(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    What is read afterwards does not depend on any executor that took part in the writing, and the
    planner sees the true size of the result.
    """
    spark = df.sparkSession
    path = path or new_table_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class CommitLog:
    """Numbered markers beside the tables of a state: a version holds as soon as its marker is there.

    A marker is written complete under another name and then given its own, and the markers before it
    stay until it has it; whatever stops a writer, the highest marker is a complete version. A number is
    committed once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._files = path.rstrip("/"), Files(spark)

    def numbers(self) -> list[int]:
        names = self._files.names(self.path)
        return sorted(int(n[7:-5]) for n in names if n.startswith("marker-") and n.endswith(".json"))

    def latest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], json.loads(self._files.read_text(f"{self.path}/marker-{numbers[-1]}.json"))) if numbers else None

    def commit(self, number: int, content: dict) -> None:
        if not self._files.write_new(f"{self.path}/marker-{number}.json", json.dumps(content)):
            raise RuntimeError(f"version {number} is committed already")
        for old in self.numbers():
            if old < number - 1:
                self._files.delete(f"{self.path}/marker-{old}.json")
