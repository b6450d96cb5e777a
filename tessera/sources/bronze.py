"""Reading and writing immutable snapshots, their manifests, and release-scoped scans over them."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.fingerprint import multiset_fingerprint
from tessera.operators.relational import only_if_single
from tessera.sources.contracts import Contract
from tessera.sources.files import Files

#: No query may plan to read more than this many bytes.
MAX_BYTES = 25 << 30
#: A table of one release has at most this many files.
MAX_FILES = 100_000


def year_extract(table: DataFrame, contract: Contract, year: int) -> DataFrame:
    """The contract's columns of one year, both pushed to the scan."""
    return table.where(F.col("ano") == F.lit(year)).select(*[name for name, _ in contract.columns])


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def guard_bytes(df: DataFrame, limit: int = MAX_BYTES) -> DataFrame:
    planned = estimated_bytes(df)
    if planned > limit:
        raise ValueError(f"the plan reads {planned} bytes, more than {limit}")
    return df


def partition_path(root: str, source: str, year: int, run: str, attempt: str) -> str:
    return f"{root.rstrip('/')}/{source}/ano={year}/run={run}/attempt={attempt}"


def export_snapshot(df: DataFrame, path: str) -> int:
    """Write once (an existing path is an error) and count what was written, not what was read."""
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def parquet_files(spark: SparkSession, path: str) -> list[str]:
    return Files(spark).find(path, ".parquet")


#: How a contract's types stand in a Parquet file.
_PARQUET_TYPES = {"bigint": "INT64", "double": "DOUBLE", "string": "BINARY STRING"}


def validate_landing(spark: SparkSession, path: str, contract: Contract) -> list[str]:
    """What is wrong with the files of a landing folder: order, names, types, nullability, compression.
    Only footers are read."""
    files, wanted, problems = Files(spark), [(f.name, _PARQUET_TYPES[f.dataType.simpleString()], f.nullable) for f in contract.schema], []
    for file in files.find(path, ".parquet"):
        columns, codecs = files.footer(file)
        name = file.rpartition("/")[2]
        if [c[:2] for c in columns] != [w[:2] for w in wanted]:
            problems.append(f"{name}: schema")
        elif columns != wanted:
            problems.append(f"{name}: nullability")
        if codecs - {"SNAPPY"}:
            problems.append(f"{name}: compression")
    return problems


def copy_immutable(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a file to a new place. The same bytes again are accepted (False: nothing was written);
    other bytes under the same name are refused."""
    files = Files(spark)
    if files.copy_new(source, target):
        return True
    if files.sha256(source) != files.sha256(target):
        raise ValueError(f"{target} exists with other content")
    return False


def schema_artifact(spark: SparkSession, contract: Contract, path: str, demo: bool = False) -> None:
    """A table without rows, or with one row of nulls for a demonstration, that pins the contract's types."""
    rows = [tuple(None for _ in contract.columns)] if demo else []
    spark.createDataFrame(rows, contract.schema).coalesce(1).write.mode("overwrite").parquet(path)


def inspect(df: DataFrame) -> list[tuple[int, str, str, str]]:
    """(ordinal, name, type, mode) of a source as it is."""
    return [(i + 1, f.name, f.dataType.simpleString(), "NULLABLE" if f.nullable else "REQUIRED") for i, f in enumerate(df.schema.fields)]


@dataclass(frozen=True)
class SourceInspection:
    location: str
    modified_ms: int
    etag: str
    columns: list[tuple[int, str, str, str]]


def inspect_source(spark: SparkSession, path: str) -> SourceInspection:
    """A stored source: where it lies, when it last changed, a tag of its files (names, sizes by their
    time of change), and its columns."""
    files = Files(spark)
    stamped = [(f, files.modified_ms(f)) for f in files.find(path, ".parquet")]
    tag = hashlib.sha256(json.dumps(stamped).encode()).hexdigest()
    return SourceInspection(path, max((t for _, t in stamped), default=0), tag, inspect(spark.read.parquet(path)))


def read_external(spark: SparkSession, pattern: str, contract: Contract) -> DataFrame:
    """Files by a pattern with wildcards, in the contract's schema; nothing is inferred from them."""
    return spark.read.schema(contract.schema).parquet(pattern)


def current_release(rows: DataFrame, files: DataFrame, pointer: DataFrame, table_name: str) -> DataFrame:
    """The rows of the files mapped to the active release: a semi-join on the file each row came from.
    ``rows`` have their file in ``file_uri``; an ambiguous pointer selects nothing."""
    active = only_if_single(pointer).select("release_id")
    chosen = files.where(F.col("table_name") == table_name).join(active, "release_id", "left_semi").select("file_uri")
    return rows.join(chosen, "file_uri", "left_semi")


def read_release(spark: SparkSession, files: DataFrame, release_id: str, table_name: str, schema: T.StructType) -> DataFrame:
    """The rows of the files selected for a release, with release, run and time of ingestion.

    The list of files is resolved first (one row per file of one release, at most ``MAX_FILES``), so no
    other file is even opened; the file's own row is then joined by the path the scan reports.
    """
    chosen = files.where((F.col("release_id") == release_id) & (F.col("table_name") == table_name) & (F.col("status") == "selected"))
    chosen = chosen.select("file_uri", "source_run_id", "ingested_at").distinct()
    uris = [r["file_uri"] for r in chosen.select("file_uri").limit(MAX_FILES + 1).collect()]
    if len(uris) > MAX_FILES:
        raise ValueError(f"more than {MAX_FILES} files in {release_id}")
    if not uris:
        empty = T.StructType([*schema.fields, T.StructField("release_id", T.StringType()), T.StructField("source_run_id", T.StringType()), T.StructField("ingested_at", T.TimestampType())])
        return spark.createDataFrame([], empty)
    rows = spark.read.schema(schema).parquet(*uris).select("*", F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/").alias("path_"))
    mapped = chosen.select(F.regexp_replace("file_uri", "^file:/*", "/").alias("path_"), F.lit(release_id).alias("release_id"), "source_run_id", "ingested_at")
    return rows.join(F.broadcast(mapped), "path_").drop("path_")  # at most MAX_FILES rows


def replace_releases(df: DataFrame, path: str) -> None:
    """Write the releases in ``df`` and replace only those; doing it twice changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release_id").parquet(path)


class ManifestStore:
    """Append-only checkpoints of runs, one JSON file for each run, attempt and status. A checkpoint that
    is stored again must be the same."""

    FORBIDDEN = "id_aluno"

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._files = path.rstrip("/"), Files(spark)

    def persist(self, manifest: dict) -> str:
        text = json.dumps(manifest, sort_keys=True) + "\n"
        if self.FORBIDDEN in text:
            raise ValueError("a manifest must not name pupils")
        name = f"{manifest['run_id']}-{manifest.get('attempt_id') or 'none'}-{manifest['status']}.json"
        place = f"{self.path}/{name}"
        if not self._files.write_new(place, text) and self._files.read_text(place) != text:
            raise ValueError(f"{name} exists with other content")
        return name

    def stored(self) -> bool:
        return any(name.endswith(".json") for name in self._files.names(self.path))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.json(self.path)

    def latest_completed(self, spark: SparkSession, keys: Sequence[str] = ("source", "year")) -> DataFrame:
        return latest_completed(self.read(spark), keys)


def latest_completed(manifests: DataFrame, keys: Sequence[str] = ("source", "year")) -> DataFrame:
    """Of each source and year the run that was completed last; one that does not say when is none."""
    done = manifests.where("status = 'completed' AND completed_at IS NOT NULL")
    return done.groupBy(*keys).agg(F.max_by("run_id", F.struct("completed_at", "run_id")).alias("run_id"))


def select_latest_completed(manifests: DataFrame, source: str, year: int) -> str:
    """The run of one source and year that was completed last; none, or two at the same moment, is an error."""
    done = manifests.where((F.col("status") == "completed") & F.col("completed_at").isNotNull() & (F.col("source") == source) & (F.col("year") == year))
    last = done.groupBy("completed_at").agg(F.min("run_id").alias("a"), F.max("run_id").alias("b")).orderBy(F.col("completed_at").desc()).limit(1).collect()
    if not last:
        raise LookupError(f"no completed run of {source} {year}")
    if last[0]["a"] != last[0]["b"]:
        raise LookupError(f"several runs of {source} {year} were completed last")
    return last[0]["a"]


def select_completed(manifests: DataFrame, expected: Sequence[tuple[str, int]]) -> dict[tuple[str, int], str]:
    """The one completed run of each source and year of a release. A missing, repeated or further one is
    an error, and so is a run that failed."""
    states = manifests.groupBy("source", "year", "run_id").agg(
        F.count_if((F.col("status") == "completed") & F.col("completed_at").isNotNull()).alias("done"), F.count_if(F.col("status") == "failed").alias("failed")
    ).limit(MAX_FILES + 1).collect()
    found: dict[tuple[str, int], list[str]] = {}
    for row in states:
        if row["failed"] and not row["done"]:
            raise LookupError(f"run {row['run_id']} failed")
        if row["done"]:
            found.setdefault((row["source"], row["year"]), []).append(row["run_id"])
    if set(found) != set(expected) or any(len(runs) != 1 for runs in found.values()):
        raise LookupError(f"completed runs {sorted(found)} are not one for each of {sorted(expected)}")
    return {key: runs[0] for key, runs in found.items()}


def execute_batch(spark: SparkSession, table: DataFrame, contract: Contract, year: int, root: str, store: ManifestStore, attempt: str, now: str, max_bytes: int = MAX_BYTES) -> dict:
    """One source and year from its table to a checked snapshot: a checkpoint before, one after. A replay
    of what was completed with the same query, columns, rows and content writes no data, it only says
    when it was verified again."""
    rows = year_extract(table, contract, year)
    guard_bytes(rows, max_bytes)
    query = f"{contract.source}|{year}|{','.join(name for name, _ in contract.columns)}"
    n, first, second = multiset_fingerprint(rows)
    known = {"query_hash": hashlib.sha256(query.encode()).hexdigest(), "schema_hash": contract.schema_hash, "fingerprint": first + second, "row_count": n}
    key = {"run_id": run_id(contract.source, year, known["query_hash"] + known["fingerprint"]), "source": contract.source, "year": year}
    if store.stored():
        before = store.read(spark).where((F.col("run_id") == key["run_id"]) & (F.col("status") == "completed")).limit(1).collect()
        if before and unchanged(before[0].asDict(), **known):
            return before[0].asDict() | {"status": "skipped", "verified_at": now}
    store.persist(key | known | {"attempt_id": attempt, "status": "incomplete", "started_at": now, "completed_at": None})
    path = partition_path(root, contract.source, year, key["run_id"], attempt)
    written = export_snapshot(rows, path)
    problems = validate_landing(spark, path, contract)
    if problems or written != n:
        store.persist(key | known | {"attempt_id": attempt, "status": "failed", "started_at": now, "completed_at": None})
        raise ValueError(f"{written} of {n} rows; {problems}")
    done = key | known | {"attempt_id": attempt, "status": "completed", "started_at": now, "completed_at": now, "verified_at": now, "path": path}
    store.persist(done)
    return done


def unchanged(manifest: dict | None, query_hash: str, schema_hash: str, fingerprint: str, row_count: int) -> bool:
    """Whether a run may be skipped: everything that made the last one is the same."""
    return manifest is not None and (manifest["query_hash"], manifest["schema_hash"], manifest["fingerprint"], manifest["row_count"]) == (
        query_hash, schema_hash, fingerprint, row_count,
    )


def run_id(source: str, year: int, key: str) -> str:
    """The same run for the same key."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{source}/{year}/{key}"))
