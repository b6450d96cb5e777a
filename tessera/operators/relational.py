"""Relational building blocks of the medallion models.

Where a group may be large the operators aggregate (combined before the shuffle) and never rank or
collect the group. Null keys form a group of their own and join nothing, as in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.domain import payload_hash

#: A dimension is sent to every task only up to this size.
BROADCAST_BYTES = 32 << 20


def small_side(dimension: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``dimension`` marked for broadcast if its rows, written as text, have at most ``limit`` bytes; else
    as it is, and the join shuffles. The size is summed by all tasks, no rows are moved for it."""
    size = dimension.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + F.lit(16))).first()[0] or 0
    return F.broadcast(dimension) if size <= limit else dimension


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the largest by ``order`` (nulls smallest). ``order`` should be total; what is
    left of ties is decided by the kept columns, so the result does not depend on the row order."""
    rest = [c for c in (keep or rows.columns) if c not in keys]
    best = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"k{i}") for i, c in enumerate(rest)]))
    return rows.groupBy(*keys).agg(best.alias("best_")).select(*keys, *[F.col(f"best_.k{i}").alias(c) for i, c in enumerate(rest)])


def ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank_") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def classify_duplicates(rows: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Per key: number of rows and whether their payloads agree (``single``, ``identical``,
    ``conflicting``). The smallest and largest digest stand for the distinct count."""
    hashed = rows.withColumn("digest_", payload_hash(*payload))
    return hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.min("digest_").alias("a_"), F.max("digest_").alias("b_")).select(
        *keys, "copies", F.when(F.col("copies") == 1, "single").when(F.col("a_") == F.col("b_"), "identical").otherwise("conflicting").alias("kind")
    )


def deduplicate(rows: DataFrame, keys: Sequence[str], payload: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Identical copies collapse to the newest by ``order``; keys with differing payloads are removed."""
    rest = [c for c in rows.columns if c not in keys]
    hashed = rows.withColumn("digest_", payload_hash(*payload))
    best = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"k{i}") for i, c in enumerate(rest)]))
    grouped = hashed.groupBy(*keys).agg(F.min("digest_").alias("a_"), F.max("digest_").alias("b_"), best.alias("best_"))
    return grouped.where("a_ = b_").select(*keys, *[F.col(f"best_.k{i}").alias(c) for i, c in enumerate(rest)])


def excess_copies(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: copies beyond the first of each key, and their part of all rows in percent."""
    copies = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    excess, total = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)), F.sum("copies")
    return copies.agg(excess.cast("long").alias("excess_rows"), (F.lit(100.0) * excess / total).alias("repeated_rate"))


def unpivot(rows: DataFrame, keys: Sequence[str], wide: Sequence[str], name: str, value: str, include_nulls: bool = False) -> DataFrame:
    long = rows.select(*keys, *wide).unpivot(list(keys), list(wide), name, value)
    return long if include_nulls else long.where(F.col(value).isNotNull())


def as_of(rows: DataFrame, keys: Sequence[str], reference: str, target: str, keep: Sequence[str]) -> DataFrame:
    """For each key the row with the latest ``reference`` that is not after ``target``."""
    return latest(rows.where(F.col(reference) <= F.col(target)), keys, [reference], [reference, *keep])


def previous_available(rows: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """The value of the row before, which need not be the period before."""
    return rows.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))


def only_if_single(pointer: DataFrame) -> DataFrame:
    """The pointer's row if there is exactly one; of none or several, no row (readers fail closed)."""
    counted = pointer.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*pointer.columns)).alias("row"))
    return counted.where("n = 1").select("row.*")


def relationship_check(child: DataFrame, parent: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """One row: references checked and missing. Null references are missing; the parent is made
    unique first, so that it cannot multiply the references."""
    known = parent.select(*[F.col(c).alias(f"p_{c}") for c in on]).distinct().withColumn("hit_", F.lit(1))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"p_{c}") for c in on])
    return child.select(*on).join(known, same, "left").agg(
        F.lit(name).alias("relation_name"), F.count(F.lit(1)).alias("checked_rows"), F.count_if(F.col("hit_").isNull()).alias("missing_rows")
    )


def orphan_rows(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    return child.join(parent.select(*on), list(on), "left_anti")


def key_violations(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def range_violations(rows: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return rows.where(~F.col(column).between(low, high))


def total_violations(rows: DataFrame, parts: Sequence[str], total: float, tolerance: float) -> DataFrame:
    """Rows whose parts do not sum to ``total``; a null part counts as 0 here."""
    added = reduce(lambda a, b: a + b, [F.coalesce(F.col(p), F.lit(0)) for p in parts])
    return rows.where(F.abs(added - F.lit(total)) > F.lit(tolerance))


def merge_upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Current rows replaced by incoming ones that are as new or newer; new keys are added."""
    both = current.withColumn("new_", F.lit(0)).unionByName(incoming.withColumn("new_", F.lit(1)))
    return latest(both, keys, [order, "new_"], current.columns)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
