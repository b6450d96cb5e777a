import statistics
from decimal import Decimal
from fractions import Fraction

import pytest

from tessera.operators import profiling as p

SCHEMA = "release_id string, taxa_alfabetizacao decimal(28,9), media_portugues decimal(28,9), load string, value string, n long"
REGISTRY = "release_id string, baseline_release_id string, load string"


def findings(spark, loads, links=()):
    rows = [(load, None if x is None else Decimal(str(x)), None, None, None, 1) for load, values in loads.items() for x in values]
    profile = p.numeric_profile(spark.createDataFrame(rows, SCHEMA), "release_id", p.SILVER_EXPECTATIONS)
    compared = p.with_baseline(profile, spark.createDataFrame([(a, b, None) for a, b in links], REGISTRY), p.SILVER_EXPECTATIONS)
    return {(r["load"], r["finding"]) for r in p.findings(compared).where("column_name = 'taxa_alfabetizacao'").collect()}


def test_thresholds_are_strict(spark):
    spread = [10.5 + i for i in range(8)]
    assert findings(spark, {"a": [*spread, 1, None]}) == set()
    assert findings(spark, {"a": [*spread, None]}) == {("a", "null_rate")}
    assert findings(spark, {"a": [50, 1, 2, 3, 4]}) == set()
    assert findings(spark, {"a": [50, 50, 2, 3, 4]}) == {("a", "top_value")}
    assert findings(spark, {"a": [0, 100, 1, 2, 3]}) == set()
    assert findings(spark, {"a": [-0.01, 100.01, 1, 2, 3]}) == {("a", "range")}
    assert findings(spark, {"a": [0.123, 1, 2, 3, 4]}) == {("a", "decimals")}
    assert findings(spark, {"a": [0.120, 1, 2, 3, 4]}) == set()


def test_shifts(spark):
    base = [30, 40, 50, 60, 70]
    assert findings(spark, {"a": base, "b": [x + 5 for x in base]}, [("b", " a")]) == set()
    assert findings(spark, {"a": base, "b": [x + 5.01 for x in base]}, [("b", "a"), ("b", "a ")]) == {("b", "mean_shift")}
    wide = [50 + (x - 50) * 1.5 for x in base]
    assert findings(spark, {"a": base, "b": wide}, [("b", "a")]) == set()
    wider = [50 + (x - 50) * 1.52 for x in base]
    assert findings(spark, {"a": base, "b": wider}, [("b", "a")]) == {("b", "spread_shift")}
    assert findings(spark, {"a": wider, "b": base}, [("b", "a")]) == {("b", "spread_shift")}
    assert findings(spark, {"a": base, "b": [99, 98, 97, 96, 95]}, [("b", "none")]) == set()


def test_equal_and_missing_values(spark):
    assert findings(spark, {"a": [7] * 3, "b": [7] * 3}, [("b", "a")]) == {("a", "top_value"), ("b", "top_value")}
    assert findings(spark, {"a": [None] * 3, "b": [1, 2, 3, 4, 5]}, [("b", "a")]) == {("a", "null_rate")}
    assert findings(spark, {}) == set()
    assert findings(spark, {"a": [99999999999, 1, 2, 3, 4]}) == {("a", "range")}


@pytest.mark.parametrize("values", [
    [Decimal("0.000000001") + i * Decimal("12.345") for i in range(50)],
    [Decimal("-9999999999999999999.999999999"), Decimal("9999999999999999999.999999999"), Decimal("10000.5"), Decimal("-0.000000001")] * 3,
    [Decimal("1000000000000000000") + i for i in range(9)],
])
def test_power_sums_are_exact_at_any_size(spark, values):
    frame = spark.createDataFrame([("a", v, None, None, None, 1) for v in values], SCHEMA)
    row = p.numeric_profile(frame, "release_id", p.SILVER_EXPECTATIONS).where("column_name = 'taxa_alfabetizacao'").first()
    whole = [int(v.scaleb(9)) for v in values]
    assert p.power_sums(row["sums"]) == (sum(whole), sum(x * x for x in whole))
    shown = p.with_baseline(
        p.numeric_profile(frame, "release_id", p.SILVER_EXPECTATIONS), spark.createDataFrame([], REGISTRY), p.SILVER_EXPECTATIONS
    ).where("column_name = 'taxa_alfabetizacao'").first()
    exact = [Fraction(x, 10**9) for x in whole]
    assert shown["mean"] == float(statistics.mean(exact)) and abs(shown["sd"] - statistics.pstdev(exact)) <= 1e-15 * shown["sd"]


def test_a_shift_beside_huge_values_is_seen(spark):
    """Doubles would lose the spread of these loads."""
    base = [10**15 + x for x in (0, 1, 2, 3, 4)]
    got = findings(spark, {"a": base, "b": [10**15 + 2 + (x - 2) * Decimal("1.6") for x in (0, 1, 2, 3, 4)], "c": [x + 6 for x in base]}, [("b", "a"), ("c", "a")])
    assert {x for x in got if x[1] not in ("range", "decimals")} == {("b", "spread_shift"), ("c", "mean_shift")}


def test_all_columns(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("a", 1, None), (None, 5, "x")], "release_id string, v long, t string")
    got = {(r["load"], r["column_name"]): tuple(r)[2:] for r in p.profile_all(frame, "release_id", {"t": "x"}).collect()}
    assert got == {
        ("a", "v"): (3, 1, 1, "1.000000000", "1.000000000", 0), (None, "v"): (1, 0, 1, "5.000000000", "5.000000000", 0),
        ("a", "t"): (3, 1, 2, "x", "y", 1), (None, "t"): (1, 0, 1, "x", "x", 0),
    }
