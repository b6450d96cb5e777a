"""Registered queries do the whole job: small folders with the rows that were left out."""

import datetime as dt
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from tessera.operators import schema_drift as drift
from tests.test_schema_drift import tables


def run(spark, tmp_path, name, **tables):
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{table}.parquet")
    return entry.queries()[name](spark, str(tmp_path))


STREAM = """delivery_id long, message_id string, event_id string, event_time string, publish_time timestamp, ingestion_time timestamp,
ano long, id_municipio string, rede string, taxa_alfabetizacao decimal(28,9)"""


def delivery(k, message, event, hour, arrived, place="1", month=7):
    at = dt.datetime(2025, 5, 1, 12, tzinfo=dt.timezone.utc)
    return (k, message, event, f"2025-{month:02d}-01T{hour:02d}:00:00Z", at, at + dt.timedelta(hours=arrived), 2024, place, "municipal", Decimal(k))


def test_rows_without_identifiers_stay_in_the_stream(spark, tmp_path):
    rows = [
        delivery(1, "m1", "A", 1, 1), delivery(2, "m1", None, 1, 2),  # the newest delivery of m1 has no event id
        delivery(3, "m2", None, 2, 1),  # a message that never has one
        delivery(4, None, "b", 3, 1), delivery(5, None, "B", 4, 1),  # two messages without id, of one event
        delivery(6, None, None, 9, 1, "2"), delivery(7, None, None, 9, 2, "2"),
        delivery(8, "m3", "c", 1, 1, "3", 4),
    ]
    got = lambda name: sorted(map(tuple, run(spark, tmp_path, name, municipal_rate_stream=(rows, STREAM)).collect()), key=repr)
    assert got("stream_transport_dedup") == [("m1", 2), ("m2", 3), ("m3", 8), (None, 4), (None, 5), (None, 6), (None, 7)]
    assert got("stream_latest") == [("b", 5, 5), ("c", 8, 8), (None, 2, 2), (None, 3, 3), (None, 6, 6), (None, 7, 7)]
    assert got("stream_audit") == [("b", None, 4)]


def test_names_of_one_file_are_never_one_column(spark):
    """a became b in one line of runs and c in another; b and c stand together in a third."""
    files = {"r1": ["a"], "r2": ["b"], "r3": ["a"], "r4": ["c"], "r5": ["b", "c"]}
    inspection, manifest = tables(
        spark, {run: [(n, "STRING", "NULLABLE") for n in names] for run, names in files.items()},
        [("r1", 2023, "completed", 1), ("r2", 2023, "completed", 2), ("r3", 2024, "completed", 1), ("r4", 2024, "completed", 2), ("r5", 2025, "completed", 1)],
    )
    assert {k: sorted(names) for k, (names, _) in drift.column_families(inspection, manifest).items()} == {"a": ["a", "b"], "c": ["c"]}
    # a record may hold both names of a family although no schema does
    records = spark.createDataFrame([("r5", 1, '{"a": "x", "b": "y", "c": "z"}')], "run_id string, line_no long, payload string")
    row = drift.consistent_table(records, inspection, manifest).first()
    assert (row["a"], row["c"], row["unconverted_"]) == ("x", "z", {"b": "y"})


def test_too_many_renames_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(drift, "MAX_PAIRS", 1, raising=False)
    monkeypatch.setattr(drift, "MAX_COLUMNS", 4)
    n = lambda *names: [(x, "STRING", "NULLABLE") for x in names]
    inspection, manifest = tables(spark, {"r1": n("a", "b"), "r2": n("c", "d")}, [("r1", 2023, "completed", 1), ("r2", 2023, "completed", 2)])
    with pytest.raises(ValueError, match="more than 1 renames"):
        drift.column_families(inspection, manifest)


def test_large_whole_numbers_stay_exact(spark):
    inspection, manifest = tables(spark, {"a": [("n", "INT64", "NULLABLE")]}, [("a", 2024, "completed", 1)])
    texts = ["9007199254740993", "9223372036854775807", '"9007199254740993"', '"9007199254740993.0"', "-9007199254740993", "3.0", '" 7 "', '"3e2"', '"3.7"', '"9223372036854775808"', '"x"']
    values = [9007199254740993, 9223372036854775807, 9007199254740993, 9007199254740993, -9007199254740993, 3, 7, 300, None, None, None]
    records = spark.createDataFrame([("a", i, f'{{"n": {t}}}') for i, t in enumerate(texts)], "run_id string, line_no long, payload string")
    wide = drift.consistent_table(records, inspection, manifest).orderBy("line_no_").collect()
    assert [r["n"] for r in wide] == values and [len(r["unconverted_"]) for r in wide] == [int(v is None) for v in values]
    long = drift.consistent_values(records, inspection, manifest).orderBy("line_no").collect()
    assert [r["canonical_int64"] for r in long] == values


def test_parents_that_exist_are_no_orphans(spark, tmp_path):
    rows, parents = ([("7",), ("7",), ("8",), ("9",), (None,)], "id_municipio string"), ([("7",), ("7",), ("8",), (None,)], "id_municipio string")
    got = {tuple(r) for r in run(spark, tmp_path, "orphan_rows", silver_municipio=rows, diretorio_municipio=parents).collect()}
    assert got == {("9", 1), (None, 1)}


def test_any_column_changes_the_fingerprint(spark, tmp_path):
    schema = "release_id string, ano long, id_municipio string, rede string, taxa_alfabetizacao long, media_portugues long, source_run_id string"
    rows = [("r", 2024, "1", "total", 50, 700, "a"), ("r", 2024, "2", "total", 50, None, "a")]
    got = lambda *changed: run(spark, tmp_path, "content_fingerprint", silver_municipio=([*changed, *rows[len(changed):]], schema)).first()
    plain = got()
    assert plain["n_rows"] == 2 and got(*reversed(rows)) == plain
    for other in ((*rows[0][:5], 701, "a"), (*rows[0][:6], "b")):
        changed = got(other)
        assert changed["n_rows"] == 2 and changed["first_sum"] != plain["first_sum"] and changed["second_sum"] != plain["second_sum"]


def test_command_line(spark, tmp_path, capsys):
    from tessera.__main__ import main

    assert main(["list"]) == 0 and "p3_found" in capsys.readouterr().out.split()
    spark.createDataFrame([(1, "x")], "n_nationkey long, n_name string").write.parquet(str(tmp_path / "in" / "nation.parquet"))
    for name in ("region", "customer", "supplier", "part", "orders"):
        spark.createDataFrame([], "a long").write.parquet(str(tmp_path / "in" / f"{name}.parquet"))
    assert main(["run", "tagged_union", str(tmp_path / "in"), str(tmp_path / "out")]) == 0 and capsys.readouterr().out.strip() == "6"
    assert {(r["table_name"], r["n_rows"]) for r in spark.read.parquet(str(tmp_path / "out")).where("n_rows > 0").collect()} == {("nation", 1)}
    with pytest.raises(SystemExit):
        main(["run", "nothing", "x"])
