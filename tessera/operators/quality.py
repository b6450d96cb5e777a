"""Measurements of a release against its baseline, each an aggregate that merges in any order.

Null handling follows SQL: a comparison with null is not counted, unless a rule asks for nulls.
Percentages are double precision. Every measurement is one pass over the tables for all releases at
once; what a release is then compared with is a join of one row per release.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = [f"proporcao_aluno_nivel_{k}" for k in range(9)]
TARGETS = [f"meta_alfabetizacao_{year}" for year in range(2024, 2031)]


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def outside(column: str, low=0, high=100) -> Column:
    return ~F.col(column).between(low, high)


def missing_or_outside(column: str) -> Column:
    return F.col(column).isNull() | outside(column)


def range_defects_results() -> Column:
    return any_of([missing_or_outside(c) for c in ("taxa_alfabetizacao", *LEVELS)])


def range_defects_targets() -> Column:
    return any_of([missing_or_outside(c) for c in ("taxa_alfabetizacao", "percentual_participacao")] + [outside(c) for c in TARGETS])


def negative_defects(columns: list[str]) -> Column:
    return any_of([F.col(c) < 0 for c in columns])


def proportion_defects(tolerance=0.5) -> Column:
    total = reduce(lambda a, b: a + b, [F.col(c) for c in LEVELS])
    return any_of([F.col(c).isNull() for c in LEVELS]) | (F.abs(total - 100) > tolerance)


def counts_by_release(rows: DataFrame, **defects: Column) -> DataFrame:
    """Rows and defects per release, one pass."""
    return rows.groupBy("release_id").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(test).alias(name) for name, test in defects.items()]
    )


def baselines(registry: DataFrame) -> DataFrame:
    """(release_id, baseline): the release it was built on, spaces around it removed."""
    return registry.groupBy("release_id").agg(F.max(F.trim("baseline_release_id")).alias("baseline"))


def against_baseline(measured: DataFrame, registry: DataFrame, columns: list[str]) -> DataFrame:
    """Each release's measurements beside those of its baseline (``base_...``, null without one)."""
    base = measured.select(F.col("release_id").alias("baseline"), *[F.col(c).alias(f"base_{c}") for c in columns])
    return measured.join(baselines(registry), "release_id", "left").join(base, "baseline", "left")


def volume_delta() -> Column:
    """Change of the row count in percent of the baseline's."""
    return F.lit(100.0) * (F.col("n_rows") - F.col("base_n_rows")) / F.col("base_n_rows")


def null_rate_delta(column: str) -> Column:
    """Change of a null rate in percentage points."""
    return F.lit(100.0) * F.col(column) / F.col("n_rows") - F.lit(100.0) * F.col(f"base_{column}") / F.col("base_n_rows")
