import datetime as dt

from tessera.operators import schema_drift as drift

INSPECTION = "run_id string, source string, ordinal long, column_name string, data_type string, column_mode string, name string, has string"
MANIFEST = "run_id string, source string, year long, status string, started_at timestamp, day string"


def tables(spark, schemas, runs):
    inspected = [(run, "s", i + 1, *c, None, None) for run, columns in schemas.items() for i, c in enumerate(columns)]
    manifest = [(run, "s", year, status, dt.datetime(2025, 1, 1) + dt.timedelta(hours=h) if h is not None else None, None) for run, year, status, h in runs]
    return spark.createDataFrame(inspected * 2, INSPECTION), spark.createDataFrame(manifest, MANIFEST)


def found(spark, schemas, runs):
    return {tuple(r) for r in drift.changes(*tables(spark, schemas, runs)).collect()}


S, N = "STRING", "NULLABLE"


def test_every_kind_of_change(spark):
    schemas = {
        "a": [("id", S, N), ("Rate", "FLOAT", N), ("gone", S, N), ("mode", S, N), ("old", "INT64", N)],
        "b": [("ID", S, N), ("rate", "FLOAT64", N), ("other", "INT64", N), ("mode", S, "REQUIRED"), ("new", "INTEGER", "REQUIRED"), ("more", S, N)],
        "c": [("more", S, N), ("id", "INT64", "REQUIRED")],
    }
    runs = [("a", 2024, "completed", 1), ("b", 2024, "failed", 30), ("b", 2024, "completed", 30), ("c", 2025, "completed", 40), ("x", 2024, "failed", 2)]
    assert found(spark, schemas, runs) == {
        ("b", "added", "other", ""), ("b", "removed", "gone", ""), ("b", "mode_changed", "mode", ""), ("b", "renamed", "new", "old"), ("b", "added", "more", ""),
    }
    runs[3] = ("c", 2024, "completed", 31)
    assert {c for c in found(spark, schemas, runs) if c[0] == "c"} == {
        ("c", "retyped", "id", ""), ("c", "mode_changed", "id", ""), *[("c", "removed", n, "") for n in ("rate", "other", "mode", "new")]
    }


def test_order_alone_is_no_change_and_the_last_completed_run_counts(spark):
    schemas = {"a": [("x", S, N), ("y", S, N)], "b": [("z", S, N)], "c": [("y", S, N), ("x", S, N)]}
    runs = [("a", 2024, "completed", 1), ("b", 2024, "incomplete", 2), ("c", 2024, "completed", 3)]
    assert found(spark, schemas, runs) == set()


def test_runs_without_columns_and_empty_tables(spark):
    runs = [("a", 2024, "completed", 1), ("b", 2024, "completed", 2)]
    assert found(spark, {"a": [("x", S, N)]}, runs) == {("b", "removed", "x", "")}
    assert found(spark, {}, []) == set()
    assert found(spark, {"a": [("x", S, N)]}, [("a", None, "completed", None)]) == set()


def test_previous_run_across_days(spark):
    runs = [(f"r{i:03d}", 2024, "completed", i * 7) for i in range(40)]
    _, manifest = tables(spark, {}, runs)
    prior = {r["run_id"]: r["prior_run"] for r in drift.completed_runs(manifest).collect()}
    assert prior == {f"r{i:03d}": f"r{i - 1:03d}" if i else None for i in range(40)}


def test_values_keep_their_branch(spark):
    schemas = {"a": [("n", "INT64", N), ("f", "FLOAT64", N), ("t", S, N)]}
    inspection, manifest = tables(spark, schemas, [("a", 2024, "completed", 1)])
    records = spark.createDataFrame(
        [("a", 1, '{"N": 3, "f": "2,5", "t": 7}'), ("a", 2, '{"n": "x", "f": null, "t": "é", "new": true}'), ("a", 3, '{"n": 1'), ("a", 4, None), ("a", 5, "[1]")],
        "run_id string, line_no long, payload string",
    )
    rows = drift.consistent_values(records, inspection, manifest).collect()
    got = {(r["line_no"], r["path"]): (r["tag"], *[x for x in (r["canonical_int64"], r["canonical_float64"], r["canonical_string"]) if x is not None]) for r in rows}
    assert got == {
        (1, "n"): ("INT64", 3), (1, "f"): ("STRING", 2.5), (1, "t"): ("INT64", "7"),
        (2, "n"): ("STRING",), (2, "f"): ("NULL",), (2, "t"): ("STRING", "é"), (2, "new"): ("BOOL", "true"),
        (3, ""): ("BROKEN",), (4, ""): ("BROKEN",), (5, ""): ("BROKEN",),
    }


def test_both_readers_convert_alike(spark):
    spellings = ["12,0", "9007199254740993", "-9007199254740993.0", "1e3", " 7 ", "3.5", "1d", "NaN", "0x1", "", "9223372036854775807", "9223372036854775808"]
    wholes = {"12,0": 12, "9007199254740993": 9007199254740993, "-9007199254740993.0": -9007199254740993, "1e3": 1000, " 7 ": 7, "9223372036854775807": 9223372036854775807}
    inspection, manifest = tables(spark, {"a": [("n", "INT64", N)]}, [("a", 2024, "completed", 1)])
    records = spark.createDataFrame([("a", i, '{"n": "%s"}' % x) for i, x in enumerate(spellings)], "run_id string, line_no long, payload string")
    long = {r["line_no"]: r["canonical_int64"] for r in drift.consistent_values(records, inspection, manifest).collect()}
    wide = {r["line_no_"]: (r["n"], r["unconverted_"]) for r in drift.consistent_table(records, inspection, manifest).collect()}
    assert long == {i: wholes.get(x) for i, x in enumerate(spellings)}
    assert wide == {i: (wholes.get(x), {} if x in wholes else {"n": x}) for i, x in enumerate(spellings)}


def test_paths_of_any_depth_keep_their_alternatives(spark):
    inspection, manifest = tables(spark, {"a": [("n", "INT64", N)], "b": [("n", "INT64", N)]}, [("a", 2024, "completed", 1), ("b", 2024, "completed", 2)])
    records = spark.createDataFrame(
        [("a", 1, '{"N": {"x": [1, 2.5, {"d.e": "t"}], "y": {}}}'), ("b", 1, '{"n": 4, "o": {"p": {"q": {"r": [[true]]}}}}'), ("b", 2, '{"n": {"x": "4"}}')],
        "run_id string, line_no long, payload string",
    )
    got = {(r["path"], r["tag"]): (r["n_values"], r["n_runs"], r["first_run"], r["declared"]) for r in drift.observed_alternatives(records, inspection, manifest).collect()}
    assert got == {
        ("n", "OBJECT"): (2, 2, "a", False), ("n", "INT64"): (1, 1, "b", True), ("n.x", "ARRAY"): (1, 1, "a", False), ("n.x", "STRING"): (1, 1, "b", False),
        ("n.x[]", "INT64"): (1, 1, "a", False), ("n.x[]", "FLOAT64"): (1, 1, "a", False), ("n.x[]", "OBJECT"): (1, 1, "a", False),
        ("n.x[].`d.e`", "STRING"): (1, 1, "a", False), ("n.y", "OBJECT"): (1, 1, "a", False), ("o", "OBJECT"): (1, 1, "b", False),
        ("o.p", "OBJECT"): (1, 1, "b", False), ("o.p.q", "OBJECT"): (1, 1, "b", False), ("o.p.q.r", "ARRAY"): (1, 1, "b", False),
        ("o.p.q.r[]", "ARRAY"): (1, 1, "b", False), ("o.p.q.r[][]", "BOOL"): (1, 1, "b", False),
    }
    values = {r["path"]: r["canonical_float64"] for r in drift.consistent_values(records, inspection, manifest).where("fused_type = 'FLOAT64'").collect()}
    assert values == {}
    empty = records.limit(0)
    assert drift.observed_alternatives(empty, inspection, manifest).count() == drift.consistent_values(empty, inspection, manifest).count() == 0


def test_hashes_that_disagree_with_the_columns(spark):
    inspection, manifest = tables(spark, {"a": [("x", S, N)], "b": [("y", S, N)], "c": [("y", S, N)], "d": [("z", S, N)]}, [(r, 2024, "completed", i) for i, r in enumerate("abcd")])
    hashes = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("d", "3"), ("d", None)], "run_id string, schema_hash string")
    assert {tuple(r) for r in drift.hash_findings(inspection, manifest.join(hashes, "run_id", "left")).collect()} == {("b", "stale_hash"), ("c", "unexplained_hash")}


def test_renamed_columns_are_one_column_of_the_wide_table(spark):
    schemas = {
        "a": [("n", "INT64", N), ("name", S, N), ("x", "INT64", N)],
        "b": [("n", "FLOAT64", N), ("name_v2", S, N), ("y", "INT64", N)],
        "c": [("n", "FLOAT64", N), ("name_v2", S, N), ("y", "INT64", N), ("x", "INT64", N)],
    }
    inspection, manifest = tables(spark, schemas, [("a", 2024, "completed", 1), ("b", 2024, "completed", 2), ("c", 2024, "completed", 3)])
    families = drift.column_families(inspection, manifest)
    assert families == {"n": (["n"], "FLOAT64"), "name_v2": (["name_v2", "name"], "STRING"), "x": (["x"], "INT64"), "y": (["y"], "INT64")}
    records = spark.createDataFrame(
        [("a", 1, '{"N": 3, "Name": "é", "x": "4"}'), ("b", 1, '{"n": "2,5", "name_v2": 7, "y": "?", "odd": 1}'), ("b", 2, "{"), ("b", 1, None), ("c", 1, '{"X": 1, "x": 2.5}')],
        "run_id string, line_no long, payload string",
    )
    got = [tuple(r) for r in drift.consistent_table(records, inspection, manifest).orderBy("run_id_", "line_no_", "broken_", "n").collect()]
    assert sorted(got, key=repr) == sorted([
        ("a", 1, 3.0, "é", 4, None, {}, None), ("b", 1, 2.5, "7", None, None, {"y": "?", "odd": "1"}, None),
        ("b", 2, None, None, None, None, None, "{"), ("b", 1, None, None, None, None, None, None), ("c", 1, None, None, None, None, {"x": "2.5"}, None),
    ], key=repr)
