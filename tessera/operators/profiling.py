"""Column profiles of tables by load, and what is odd in a load against the load it was built on.

Every column is reduced to the multiset ``(load, column, value, n)`` first, combined before the
shuffle. From it come, by sums that merge in any order, rows, nulls, distinct values, extremes,
pattern violations and the power sums n, sum(x), sum(x^2) of the numeric columns. These are exact for
every value of decimal(28,9): a value is taken as three whole numbers, its billions, the rest before
the point and the nine decimals, and the products of these are summed. Of the one row that each load
and column has in the end, means and spreads of two loads are compared as fractions of whole numbers.

Defined cases
* a load is all rows of one release id, repeated ones as often as they are stored; rows without
  release id are the load ``null``, which has no baseline;
* a column that is null throughout has no top value, range or shift;
* thresholds are strict: exactly a tenth null, a fifth in one value, or 1.5 times is no finding;
* the spread of a load of equal values is 0: against it every other spread is larger;
* of several baselines of a release the largest is taken; space around it does not count; a baseline
  without load, or whose load has no value in the column, gives no shift;
* a value with more than nine decimals is taken to nine, one beyond 10^19 as null;
* an empty table has no loads; further columns of the inputs are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import trimmed


@dataclass(frozen=True)
class Expectation:
    """What is expected of a numeric column: range, largest shift of the mean, pattern of the value
    written with nine decimals."""

    low: int
    high: int
    mean_shift: int
    pattern: str = r"\A-?[0-9]+\.[0-9]{2}0*\z"


#: Nine decimals; the base of a value's three parts.
_BASE = 10**9

NULL_RATE, TOP_SHARE, SPREAD = Fraction(1, 10), Fraction(1, 5), Fraction(3, 2)

SILVER_EXPECTATIONS = {
    "taxa_alfabetizacao": Expectation(0, 100, 5),
    "media_portugues": Expectation(0, 1000, 25),
}


def value_counts(table: DataFrame, load: str, columns: list[str], kind: str = "string") -> DataFrame:
    """The multiset (load, column_name, value, n) of all named columns, in one pass."""
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value")) for c in columns])).alias("pair")
    return table.select(F.col(load).alias("load"), pair).groupBy("load", "pair.column_name", "pair.value").agg(F.count(F.lit(1)).alias("n"))


def numeric_profile(table: DataFrame, load: str, expectations: dict[str, Expectation]) -> DataFrame:
    """One row per load and numeric column: counts, violations and power sums."""
    counts = value_counts(table, load, list(expectations), "decimal(28,9)")
    is_column = lambda c: F.col("column_name") == c
    outside, odd = F.lit(False), F.lit(False)
    for name, e in expectations.items():
        outside = F.when(is_column(name), ~F.col("value").between(e.low, e.high)).otherwise(outside)
        odd = F.when(is_column(name), ~F.col("value").cast("string").rlike(e.pattern)).otherwise(odd)
    value, n = F.col("value"), F.col("n").cast("decimal(17,0)")
    whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    base = F.lit(_BASE).cast("decimal(10,0)")
    billions = F.call_function("div", whole, base).cast("decimal(11,0)")
    units = (whole % base).cast("decimal(9,0)")
    decimals = ((value - whole).cast("decimal(9,9)") * base).cast("decimal(9,0)")
    parts = [billions, units, decimals]
    powers = parts + [(parts[i] * parts[j]).cast("decimal(21,0)") for i in range(3) for j in range(i, 3)]
    sums = counts.groupBy("load", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("n_null"),
        F.count("value").alias("n_distinct"),
        F.coalesce(F.max(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).cast("long").alias("top_count"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).cast("long").alias("n_outside"),
        F.coalesce(F.sum(F.when(odd, F.col("n"))), F.lit(0)).cast("long").alias("n_pattern"),
        F.array(*[F.coalesce(F.sum((p * n).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for p in powers]).alias("sums"),
    )
    return sums.withColumn("n_values", (F.col("n_rows") - F.col("n_null")).cast("long"))


def power_sums(sums) -> tuple[int, int]:
    """sum(x) and sum(x^2) of values in billionths, from the sums of the products of their parts."""
    h, u, d, hh, hu, hd, uu, ud, dd = map(int, sums)
    return h * _BASE**2 + u * _BASE + d, hh * _BASE**4 + 2 * hu * _BASE**3 + (2 * hd + uu) * _BASE**2 + 2 * ud * _BASE + dd


def _moments(n, sums) -> tuple[Fraction, Fraction] | None:
    """Mean and population variance, exactly."""
    if pd.isna(n) or not n or sums is None:
        return None
    n, (x1, x2) = int(n), power_sums(sums)
    return Fraction(x1, n * _BASE), Fraction(n * x2 - x1 * x1, (n * _BASE) ** 2)


def _compare(batches: Iterator[pd.DataFrame], shifts: dict[str, int]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for column, n, sums, base_n, base_sums in zip(batch["column_name"], batch["n_values"], batch["sums"], batch["base_n_values"], batch["base_sums"], strict=True):
            own, base = _moments(n, sums), _moments(base_n, base_sums)
            moved = spread = False
            if own and base:
                moved = column in shifts and abs(own[0] - base[0]) > shifts[column]
                spread = own[1] > SPREAD**2 * base[1] or own[1] * SPREAD**2 < base[1]
            numbers = [x for m in (own, base) for x in ((float(m[0]), math.sqrt(m[1])) if m else (None, None))]
            rows.append((*numbers, moved, spread))
        found = pd.DataFrame(rows, columns=["mean", "sd", "base_mean", "base_sd", "mean_shift", "spread_shift"], dtype=object)
        yield pd.concat([batch.drop(columns=["sums", "base_sums"]).reset_index(drop=True), found], axis=1)


def with_baseline(profile: DataFrame, registry: DataFrame, expectations: dict[str, Expectation]) -> DataFrame:
    """Each load's profile beside that of the load it was built on (columns ``base_...``), with means,
    spreads and whether they shifted. There is one row for each load and column here."""
    links = registry.where(F.col("release_id").isNotNull()).groupBy(F.col("release_id").alias("load")).agg(F.max(trimmed(F.col("baseline_release_id"))).alias("base_load"))
    base = profile.select(F.col("load").alias("base_load"), F.col("column_name"), F.col("n_values").alias("base_n_values"), F.col("sums").alias("base_sums"))
    both = profile.join(links, "load", "left").join(base, ["base_load", "column_name"], "left")
    shifts = {name: e.mean_shift for name, e in expectations.items()}
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.schema if f.name not in ("sums", "base_sums"))
    schema = f"{kept}, mean double, sd double, base_mean double, base_sd double, mean_shift boolean, spread_shift boolean"
    return both.mapInPandas(lambda batches: _compare(batches, shifts), schema)


def findings(compared: DataFrame) -> DataFrame:
    """(load, column_name, finding) for whatever is odd."""
    odd = {
        "null_rate": F.col("n_null") * NULL_RATE.denominator > F.col("n_rows") * NULL_RATE.numerator,
        "range": F.col("n_outside") > 0,
        "decimals": F.col("n_pattern") > 0,
        "top_value": F.col("top_count") * TOP_SHARE.denominator > F.col("n_values") * TOP_SHARE.numerator,
        "mean_shift": F.col("mean_shift"),
        "spread_shift": F.col("spread_shift"),
    }
    listed = F.array_compact(F.array(*[F.when(test, name) for name, test in odd.items()]))
    return compared.select("load", "column_name", F.explode(listed).alias("finding"))


def profile_all(table: DataFrame, load: str, patterns: dict[str, str]) -> DataFrame:
    """Every column by load: rows, nulls, distinct values, extremes (as text order for text, by size
    for numbers and times) and values against the column's pattern."""
    numeric = [f.name for f in table.schema if f.dataType.typeName() in ("decimal", "long", "integer", "double", "float") and f.name != load]
    other = [c for c in table.columns if c not in numeric and c != load]
    parts = []
    for columns, kind in ((numeric, "decimal(28,9)"), (other, "string")):
        if not columns:
            continue
        breaks = F.lit(False)
        for name, pattern in patterns.items():
            if name in columns:
                breaks = F.when(F.col("column_name") == name, ~F.col("value").cast("string").rlike(pattern)).otherwise(breaks)
        parts.append(
            value_counts(table, load, columns, kind).groupBy("load", "column_name").agg(
                F.sum("n").alias("n_rows"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("n_null"),
                F.count("value").alias("n_distinct"),
                F.min("value").cast("string").alias("min_value"),
                F.max("value").cast("string").alias("max_value"),
                F.coalesce(F.sum(F.when(breaks, F.col("n"))), F.lit(0)).cast("long").alias("n_pattern"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
