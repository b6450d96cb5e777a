import datetime as dt

import pytest
from pyspark.sql import types as T

from tessera.sources import bronze, contracts
from tessera.sources.control import ControlTable, StaleVersion
from tessera.sources.retry import with_retries


def uf_rows(spark, n=3):
    schema = contracts.contract("uf").schema
    return spark.createDataFrame([tuple(2024 if f.name == "ano" else "x" if f.dataType == T.StringType() else float(i) for f in schema) for i in range(n)], schema)


def test_contracts_and_drift():
    schema = contracts.contract("alunos").schema
    assert [f.name for f in schema][:4] == ["ano", "id_municipio", "id_escola", "id_aluno"]
    assert not contracts.compare_schema(schema, T.StructType([*schema.fields, T.StructField("new", T.LongType())])).blocking
    drift = contracts.compare_schema(schema, T.StructType([T.StructField("ano", T.StringType()), *schema.fields[2:]]))
    assert drift.blocking and drift.removed == ("id_municipio",) and drift.retyped == ("ano",)
    assert len({contracts.contract(s).schema_hash for s in contracts.SOURCES}) == 6


def test_snapshot_is_written_once_and_valid(spark, tmp_path):
    contract, path = contracts.contract("uf"), bronze.partition_path(str(tmp_path), "uf", 2024, "r", "1")
    assert bronze.export_snapshot(bronze.year_extract(uf_rows(spark), contract, 2024), path) == 3
    assert bronze.validate_landing(spark, path, contract) == []
    assert bronze.validate_landing(spark, path, contracts.contract("municipio"))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        bronze.export_snapshot(uf_rows(spark), path)
    uf_rows(spark).write.option("compression", "gzip").parquet(str(tmp_path / "gz"))
    assert any("compression" in p for p in bronze.validate_landing(spark, str(tmp_path / "gz"), contract))
    bronze.schema_artifact(spark, contract, str(tmp_path / "empty"))
    assert spark.read.parquet(str(tmp_path / "empty")).schema == contract.schema
    assert bronze.inspect(uf_rows(spark))[0] == (1, "ano", "bigint", "NULLABLE")


def test_immutable_copy(spark, tmp_path):
    a, b, target = tmp_path / "a", tmp_path / "b", str(tmp_path / "x" / "t")
    a.write_bytes(b"1")
    b.write_bytes(b"2")
    assert bronze.copy_immutable(spark, str(a), target) and not bronze.copy_immutable(spark, str(a), target)
    with pytest.raises(ValueError, match="other content"):
        bronze.copy_immutable(spark, str(b), target)
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith(".")] == ["t"] and (tmp_path / "x" / "t").read_bytes() == b"1"


def test_nullability_external_reads_and_inspection(spark, tmp_path):
    contract = contracts.contract("uf")
    strict = T.StructType([T.StructField(f.name, f.dataType, f.name != "ano") for f in contract.schema])
    assert contracts.compare_schema(contract.schema, strict).mode_changed == ("ano",) and contracts.compare_schema(contract.schema, strict).blocking
    for k in (1, 2):
        uf_rows(spark, k).coalesce(1).write.parquet(str(tmp_path / f"run={k}"))
    assert bronze.read_external(spark, str(tmp_path / "run=*"), contract).count() == 3
    one = bronze.inspect_source(spark, str(tmp_path / "run=1"))
    assert one.modified_ms > 0 and one.columns[1][:2] == (2, "sigla_uf") and one == bronze.inspect_source(spark, str(tmp_path / "run=1"))
    assert one.etag != bronze.inspect_source(spark, str(tmp_path / "run=2")).etag
    bronze.schema_artifact(spark, contract, str(tmp_path / "demo"), demo=True)
    assert spark.read.parquet(str(tmp_path / "demo")).count() == 1


def test_rows_of_the_active_release(spark):
    rows = spark.createDataFrame([("f1", 1), ("f2", 2), ("f3", 3)], "file_uri string, v long")
    files = spark.createDataFrame([("r1", "uf", "f1"), ("r1", "uf", "f1"), ("r1", "alunos", "f2"), ("r2", "uf", "f3")], "release_id string, table_name string, file_uri string")
    pointer = lambda *ids: spark.createDataFrame([(i,) for i in ids], "release_id string")
    read = lambda p: {r["v"] for r in bronze.current_release(rows, files, p, "uf").collect()}
    assert (read(pointer("r1")), read(pointer("r2")), read(pointer("r1", "r2")), read(pointer())) == ({1}, {3}, set(), set())


def test_release_scan_reads_only_selected_files(spark, tmp_path):
    uris = []
    for k in range(3):
        uf_rows(spark, k + 1).coalesce(1).write.parquet(str(tmp_path / f"p{k}"))
        uris.append(str(bronze.parquet_files(spark, str(tmp_path / f"p{k}"))[0]))
    at = dt.datetime(2025, 1, 1)
    files = spark.createDataFrame(
        [("r1", "uf", uris[0], "run", at, "selected"), ("r1", "uf", uris[1], "run2", at, "discarded"), ("r2", "uf", uris[2], "run3", at, "selected")],
        "release_id string, table_name string, file_uri string, source_run_id string, ingested_at timestamp, status string",
    )
    got = bronze.read_release(spark, files, "r1", "uf", contracts.contract("uf").schema)
    assert [(r["release_id"], r["source_run_id"]) for r in got.collect()] == [("r1", "run")]
    assert bronze.read_release(spark, files, "r9", "uf", contracts.contract("uf").schema).count() == 0


def test_releases_are_replaced_alone(spark, tmp_path):
    rows = lambda *pairs: spark.createDataFrame(pairs, "v long, release_id string")
    path = str(tmp_path / "silver")
    for part in (rows((1, "a"), (2, "b")), rows((3, "b")), rows((3, "b"))):
        bronze.replace_releases(part, path)
    assert {tuple(r) for r in spark.read.parquet(path).select("v", "release_id").collect()} == {(1, "a"), (3, "b")}


def test_manifests_and_skipping(spark, tmp_path):
    store = bronze.ManifestStore(spark, str(tmp_path))
    base = {"source": "uf", "year": 2024, "query_hash": "q", "schema_hash": "s", "fingerprint": "f", "row_count": 1}
    for run, status, at in (("r1", "completed", "2025-01-01"), ("r2", "completed", "2025-02-01"), ("r3", "failed", "2025-03-01")):
        store.persist(base | {"run_id": run, "status": status, "completed_at": at})
    again = base | {"run_id": "r2", "status": "completed", "completed_at": "2025-02-01"}
    assert store.persist(again) == "r2-none-completed.json"  # the same again
    with pytest.raises(ValueError, match="other content"):
        store.persist(again | {"row_count": 2})
    store.persist(base | {"run_id": "r5", "status": "completed", "completed_at": None})
    assert store.latest_completed(spark).first()["run_id"] == "r2" == bronze.select_latest_completed(store.read(spark), "uf", 2024)
    for source, extra in (("none", None), ("uf", "r6")):
        if extra:
            store.persist(again | {"run_id": extra})
        with pytest.raises(LookupError):
            bronze.select_latest_completed(store.read(spark), source, 2024)
    assert bronze.unchanged(base, "q", "s", "f", 1) and not bronze.unchanged(base, "q", "s", "g", 1) and not bronze.unchanged(None, "q", "s", "f", 1)
    assert bronze.run_id("uf", 2024, "k") == bronze.run_id("uf", 2024, "k")
    with pytest.raises(ValueError, match="pupils"):
        store.persist(base | {"run_id": "r4", "columns": ["id_aluno"]})


def test_cost_guard(spark):
    assert bronze.guard_bytes(spark.range(10)).count() == 10
    with pytest.raises(ValueError, match="more than"):
        bronze.guard_bytes(spark.range(1000), 10)


def test_control_table_swaps_or_fails(spark, tmp_path):
    table = ControlTable(spark, str(tmp_path), "release_id string, prior string")
    assert table.version() == 0 and table.read(spark).count() == 0
    assert table.commit([{"release_id": "a"}], 0) == 1
    with pytest.raises(StaleVersion):
        table.commit([{"release_id": "b"}], 0)
    table.commit([{"release_id": "b", "prior": "a"}], 1)
    assert table.read(spark).first()["prior"] == "a" and table.read(spark, 1).first()["release_id"] == "a"
    assert not [p for p in tmp_path.glob(".*") if not p.name.endswith(".crc")]


def test_retries_are_bounded():
    calls, seen = [], []

    def fails(error, times):
        calls.append(1)
        if len(calls) <= times:
            raise error
        return "ok"

    assert with_retries(lambda: fails(TimeoutError(), 2), (TimeoutError,), seen=lambda n, e: seen.append(n)) == "ok" and seen == [1, 2]
    calls.clear()
    with pytest.raises(TimeoutError):
        with_retries(lambda: fails(TimeoutError(), 9), (TimeoutError,))
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(ValueError, match="x"):
        with_retries(lambda: fails(ValueError("x"), 9), (TimeoutError,))
    assert len(calls) == 1
