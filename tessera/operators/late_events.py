"""Per-period aggregates by event time, corrected by what arrives late.

The state of a period is the multiset of its values, kept as one row ``(period, revision, value, n)``
for each different value. A late record adjusts one count; medians, distinct counts and extremes are
derived again from cumulative counts, never from the records. The state over batches of arrivals is
``streaming.late_state.MultisetStore``.

Defined cases
* a row without a readable event time, or without any arrival time, has fate ``unplaced`` and no
  part in any aggregate; it is not lost, ``route`` returns it;
* arrival before the event time (a producer's clock ahead) is on time, as is any arrival before the
  end of the period;
* a null value counts as a row of its period (``n_rows``) but is no value: it is neither distinct
  nor in the median; a period of null values only has a null median, minimum and maximum;
* repeated rows count as often as they are stored, ties need no order, an empty table gives none;
* further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import DAY_US, HOUR_US, arrival, instant, micros, utc_day_number

ON_TIME, CORRECTION, DROPPED, UNPLACED = "on_time", "correction", "dropped", "unplaced"


@dataclass(frozen=True)
class LatePolicy:
    """``cutoff_hours``: an arrival later than this after its event is dropped."""

    cutoff_hours: int = 72


def stream_rows(stream: DataFrame) -> DataFrame:
    """The columns of the event table that the operator needs: row id, event, arrival and value."""
    return stream.select(
        F.col("delivery_id").alias("row_id"),
        micros(instant(F.col("event_time"))).alias("event_us"),
        micros(arrival()).alias("arrival_us"),
        F.col("taxa_alfabetizacao").alias("value"),
    )


def route(rows: DataFrame, policy: LatePolicy = LatePolicy()) -> DataFrame:
    """Admission: each row's period (day number), fate and revision.

    ``revision`` is the number of days between the period and the day of arrival; the period's
    aggregates change with every revision up to the cut-off. Rows on time are revision 0.
    """
    period_end = (F.col("period") + F.lit(1)).cast("long") * F.lit(DAY_US)
    lateness = F.col("arrival_us") - F.col("event_us")
    fate = (
        F.when(F.col("event_us").isNull() | F.col("arrival_us").isNull(), UNPLACED)
        .when(F.col("arrival_us") < period_end, ON_TIME)
        .when(lateness > F.lit(policy.cutoff_hours * HOUR_US), DROPPED)
        .otherwise(CORRECTION)
    )
    placed = rows.withColumn("period", utc_day_number(F.col("event_us"))).withColumn("fate", fate)
    revision = F.when(F.col("fate") == ON_TIME, 0).when(
        F.col("fate").isin(CORRECTION, DROPPED), utc_day_number(F.col("arrival_us")) - F.col("period")
    )
    return placed.withColumn("revision", revision.cast("int"))


def adjustments(rows: DataFrame, policy: LatePolicy = LatePolicy()) -> DataFrame:
    """What every arrival does to its period's multiset: ``delta`` is added to the count of
    ``(period, value)``; a dropped row is listed with delta 0."""
    return route(rows, policy).where(F.col("fate") != UNPLACED).withColumn(
        "delta", F.when(F.col("fate") == DROPPED, 0).otherwise(1).cast("long")
    )


def multiset(adjusted: DataFrame, *by: str) -> DataFrame:
    """Counts of each value of a period (and of whatever else ``by`` names). Counting is combined
    before the shuffle, so a period that holds a third of all rows moves only its distinct values."""
    return (
        adjusted.where(F.col("delta") != 0)
        .groupBy("period", *by, "value")
        .agg(F.sum("delta").alias("n"))
        .where(F.col("n") != 0)
    )


def correction_counts(state: DataFrame, log: DataFrame) -> DataFrame:
    """What lateness did to each value of a period: its count when the period closed, what corrections
    added, what was refused, and the count it has now."""
    nothing = F.lit(0).cast("long")
    part = lambda test: F.when(test, F.col("n")).otherwise(nothing)
    admitted = state.select("period", "value", part(F.col("revision") == 0).alias("n_closed"), part(F.col("revision") > 0).alias("n_correction"), nothing.alias("n_dropped"))
    refused = log.where(F.col("fate") == DROPPED).select("period", "value", nothing.alias("n_closed"), nothing.alias("n_correction"), F.lit(1).cast("long").alias("n_dropped"))
    counted = admitted.unionByName(refused).groupBy("period", "value").agg(*[F.sum(c).alias(c) for c in ("n_closed", "n_correction", "n_dropped")])
    return counted.where("n_correction + n_dropped > 0").withColumn("n", F.col("n_closed") + F.col("n_correction"))


def merge_multisets(parts: DataFrame) -> DataFrame:
    """The state after several batches of adjustments: counts of equal values add up."""
    return parts.groupBy("period", "revision", "value").agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def revisions(state: DataFrame, last: int) -> DataFrame:
    """From counts by revision, the full multiset as it stood at each revision 0..last."""
    return (
        state.withColumn("revision", F.explode(F.sequence(F.col("revision"), F.lit(last))))
        .groupBy("period", "revision", "value")
        .agg(F.sum("n").alias("n"))
    )


def aggregates(state: DataFrame, *keys: str) -> DataFrame:
    """Rows, distinct values, minimum, maximum and exact median of each period from its multiset.

    The cumulative counts are taken in two levels, first over the whole numbers of the values, then
    over the values of the one or two whole numbers in which a middle rank falls; no task gets the
    values of a whole period. The median of an even count is the mean of the two middle values.
    """
    keys = keys or ("period",)
    keyed = state.withColumn("unit", F.floor("value").cast("decimal(20,0)"))
    units = keyed.groupBy(*keys, "unit").agg(
        F.sum("n").alias("n"), F.count("value").alias("distinct"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    totals = units.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("unit").isNotNull(), F.col("n"))), F.lit(0)).cast("long").alias("n_values"),
        F.sum("distinct").alias("n_distinct"),
        F.min("low").alias("min_value"),
        F.max("high").alias("max_value"),
    )
    per_unit = Window.partitionBy(*keys).orderBy("unit")
    ranked = (
        units.where(F.col("unit").isNotNull())
        .withColumn("upto", F.sum("n").over(per_unit))
        .withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    low_rank = F.call_function("div", F.col("all") + 1, F.lit(2))
    high_rank = F.call_function("div", F.col("all"), F.lit(2)) + 1
    middle = ranked.where((F.col("before") < high_rank) & (F.col("upto") >= low_rank)).select(
        *[F.col(k).alias(f"mid_{k}") for k in keys], F.col("unit").alias("mid_unit"), "before", low_rank.alias("low_rank"), high_rank.alias("high_rank")
    )
    within = Window.partitionBy(*keys, "unit").orderBy("value")
    same = [F.col(k).eqNullSafe(F.col(f"mid_{k}")) for k in keys] + [F.col("unit") == F.col("mid_unit")]
    values = (
        keyed.join(middle, reduce(lambda a, b: a & b, same))
        .withColumn("upto", F.col("before") + F.sum("n").over(within))
    )
    above = F.col("upto") - F.col("n")
    medians = values.groupBy(*keys).agg(
        F.max(F.when((above < F.col("low_rank")) & (F.col("upto") >= F.col("low_rank")), F.col("value"))).alias("lower"),
        F.max(F.when((above < F.col("high_rank")) & (F.col("upto") >= F.col("high_rank")), F.col("value"))).alias("upper"),
    )
    middle_value = ((F.col("lower") + F.col("upper")) / F.lit(2)).cast("double")
    return totals.join(medians, list(keys), "left").select(
        *keys, "n_rows", "n_values", "n_distinct", "min_value", "max_value", middle_value.alias("median_value")
    )
