import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.functions.domain import normalize_municipality_id, normalize_network, rate, year_start
from tessera.operators import fingerprint, quality, relational

T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)


@pytest.mark.parametrize(("domain", "texts", "names"), [
    ("assessment_result", ["0", "2", "3", " 5 ", "1", None, "Pública"], ["total", "estadual", "municipal", "publica", None, None, "publica"]),
    ("student_dependency", ["1", "2", "3", "4", "5", ""], ["federal", "estadual", "municipal", "privada", None, None]),
    ("target", [" MUNICIPAL ", " PÚBLICA ", "Pública", "3", "Federal"], ["municipal", "publica", "publica", None, "federal"]),
])
def test_networks(spark, domain, texts, names):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(normalize_network(F.col("t"), domain)).collect()] == names


def test_unknown_domain():
    with pytest.raises(ValueError, match="unknown"):
        normalize_network(None, "other")


def test_ids_rates_and_years(spark):
    rows = spark.createDataFrame([(" 12\n",), ("1234567",), ("12345678",), ("12a",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(normalize_municipality_id(F.col("t"))).collect()] == ["0000012", "1234567", None, None, None, None]
    values = spark.createDataFrame([(0.1,), (None,)], "x double").select(rate(F.col("x"))).collect()
    assert [v[0] for v in values] == [Decimal("0.100000000"), None]
    assert spark.range(1).select(year_start(F.lit(2024))).first()[0] == dt.date(2024, 1, 1)


def silver(spark, rows):
    return spark.createDataFrame(rows, "k string, v long, run string, at timestamp")


def test_identical_copies_collapse_and_conflicts_go(spark):
    rows = silver(spark, [("RR", 1, "a", T1), ("RR", 1, "b", T2), ("SP", 61, "a", T1), ("SP", 62, "a", T1), (None, None, "a", T1), (None, None, "b", T1), ("X", None, "a", T1), ("X", 1, "a", T1)])
    got = {(r["k"], r["v"], r["run"]) for r in relational.deduplicate(rows, ["k"], ["v"], ["at", "run"]).collect()}
    assert got == {("RR", 1, "b"), (None, None, "b")}
    kinds = {r["k"]: r["kind"] for r in relational.classify_duplicates(rows, ["k"], ["v"]).collect()}
    assert kinds == {"RR": "identical", "SP": "conflicting", None: "identical", "X": "conflicting"}


def test_as_of_and_unpivot(spark):
    wide = spark.createDataFrame([("a", 2023, 70, None), ("a", 2024, 71, 80), ("b", 2025, 1, 2)], "g string, ref long, m_2024 long, m_2025 long")
    long = relational.unpivot(wide, ["g", "ref"], ["m_2024", "m_2025"], "n", "m")
    assert long.count() == 5 and relational.unpivot(wide, ["g", "ref"], ["m_2024", "m_2025"], "n", "m", True).count() == 6
    chosen = relational.as_of(long.withColumn("y", F.expr("right(n, 4)").cast("long")), ["g", "y"], "ref", "y", ["m"])
    assert {tuple(r) for r in chosen.select("g", "y", "ref", "m").collect()} == {("a", 2024, 2024, 71), ("a", 2025, 2024, 80), ("b", 2025, 2025, 2)}


def test_lag_guard_and_upsert(spark):
    rows = spark.createDataFrame([("m", 2020, 60), ("m", 2023, 68)], "g string, y long, v long")
    assert [r["p"] for r in relational.previous_available(rows, ["g"], "y", "v", "p").orderBy("y").collect()] == [None, 60]
    assert relational.only_if_single(rows).count() == 0 and relational.only_if_single(rows.where("y = 2020")).first()["v"] == 60
    assert relational.only_if_single(rows.where("y = 1")).count() == 0
    new = spark.createDataFrame([("m", 2023, 99), ("n", 1, 1)], "g string, y long, v long")
    merged = relational.merge_upsert(rows.where("y = 2023"), new, ["g"], "y")
    assert {tuple(r) for r in merged.collect()} == {("m", 2023, 99), ("n", 1, 1)}
    older = relational.merge_upsert(rows.where("y = 2023"), rows.where("y = 2020"), ["g"], "y")
    assert older.first()["v"] == 68


def test_relationships_and_violations(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    parent = spark.createDataFrame([("a", 1), ("a", 2)], "k string, x long")
    assert tuple(relational.relationship_check(child, parent, ["k"], "r").first()) == ("r", 4, 2)
    assert relational.orphan_rows(child, parent, ["k"]).count() == 2
    assert relational.key_violations(child, ["k"]).first()["copies"] == 2
    assert relational.excess_copies(child, ["k"]).first()["excess_rows"] == 1
    levels = spark.createDataFrame([(99.4, None), (99.5, 0.0), (50.0, 50.6)], "p double, q double")
    assert relational.total_violations(levels, ["p", "q"], 100, 0.5).count() == 2


def test_null_is_not_counted_unless_asked_for(spark):
    rows = spark.createDataFrame([(None,), (50,), (101,), (-1,)], "x long")
    assert rows.where(quality.outside("x")).count() == 2 and rows.where(quality.missing_or_outside("x")).count() == 3
    assert rows.where(quality.negative_defects(["x"])).count() == 1


def test_fingerprint_of_a_multiset(spark):
    frame = lambda v: spark.createDataFrame([(x, None) for x in v], "a long, b string")
    one = fingerprint.multiset_fingerprint(frame([1, 1, 2, 2]))
    assert one == fingerprint.multiset_fingerprint(frame([2, 1, 2, 1]).repartition(3).select("b", "a"))
    assert one != fingerprint.multiset_fingerprint(frame([3, 3, 4, 4])) and one != fingerprint.multiset_fingerprint(frame([1, 2]))
    assert fingerprint.multiset_fingerprint(frame([])) == (0, "0" * 64, "0" * 64)
    assert fingerprint.xor_fingerprint(frame([1, 1, 2, 2])).first()["fingerprint"] == fingerprint.xor_fingerprint(frame([3, 3, 4, 4])).first()["fingerprint"] == 0
