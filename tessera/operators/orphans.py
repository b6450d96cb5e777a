"""References to records that do not exist: keyed pending-orphan state over time.

The parent side is an index: for each key the disjoint spans of days on which it exists, made from
parent arrivals and removals. New references probe the index on their day; those that find nothing
open as orphans. For each key the later edges of its spans then say when waiting orphans are resolved
(a parent arrives) and when they are opened again (it is removed), and snapshots count what is open.

Defined cases
* null references are no references; an empty one is a reference to an empty key;
* a span starts at ``valid_from`` (null: always) and ends before ``valid_to`` (null: open); a span that
  ends before it starts holds no day; repeated and overlapping spans are one;
* a reference without a day meets only spans that are open on both sides;
* equal references of one table, period and day are one state row with their number;
* parent rows without key are ignored; empty tables give empty results (all references of a table
  whose parent is empty are orphans); further columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import CommitLog, cut, drop_path, new_table_path

ALWAYS, OPEN = "0001-01-01", "9999-12-31"

#: The parent index goes to every task only up to this many spans (about 64 bytes each); a larger one
#: is shuffled with the references.
BROADCAST_SPANS = 200_000


def parent_index(parents: DataFrame) -> DataFrame:
    """(key, spans): the disjoint spans [from, to) of days on which the key exists, in order."""
    spans = parents.where(F.col("key").isNotNull()).select(
        "key", F.coalesce("valid_from", F.lit(ALWAYS).cast("date")).alias("a"), F.coalesce("valid_to", F.lit(OPEN).cast("date")).alias("b")
    ).where(F.col("a") < F.col("b")).distinct()
    order = Window.partitionBy("key").orderBy("a", "b")
    reached = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(reached.isNull() | (reached < F.col("a")), 1).otherwise(0))
    grouped = marked.withColumn("run", F.sum("new").over(order)).groupBy("key", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return grouped.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))


def new_references(references: DataFrame) -> DataFrame:
    """References by table, release, period, key and day, counted before the shuffle."""
    return (
        references.where(F.col("ref_key").isNotNull())
        .groupBy("table_name", "release_id", "ano", "ref_key", "day")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _probe(references: DataFrame, index: DataFrame) -> DataFrame:
    spans = index.agg(F.sum(F.size("spans"))).first()[0] or 0
    side = F.broadcast(index) if spans <= BROADCAST_SPANS else index
    return references.join(side, references["ref_key"] == side["key"], "left").drop("key")


def changed_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys whose spans are not the same in two indexes: parents that came, went or changed."""
    old = before.select(F.col("key").alias("old_key"), F.col("spans").alias("old_spans"))
    both = after.join(old, F.col("key") == F.col("old_key"), "full")
    return both.where(~F.col("spans").eqNullSafe(F.col("old_spans"))).select(F.coalesce("key", "old_key").alias("key"))


def advance(pending: DataFrame | None, references: DataFrame, index: DataFrame, changed: DataFrame | None = None) -> DataFrame:
    """The state after a batch: what waited before and what the batch brought, each with the day it
    opened, was first resolved and last opened again under the current index.

    ``opened`` is false for references that found their parent on arrival; they stay in the state, for
    a later removal of the parent opens them. With the ``changed_keys`` of the index since the last
    batch, only references of those keys and of the batch's are probed, the others are carried over;
    without, all are. A parent that comes to be known later resolves also in the past.
    """
    rows = new_references(references)
    carried = None
    if pending is not None:
        old = pending
        if changed is not None:
            touched = changed.select(F.col("key").alias("touched")).unionByName(rows.select(F.col("ref_key").alias("touched"))).distinct()
            carried = pending.join(touched, F.col("ref_key") == F.col("touched"), "left_anti")
            old = pending.join(touched, F.col("ref_key") == F.col("touched"), "left_semi")
        old = old.select("table_name", "release_id", "ano", "ref_key", "day", "n")
        rows = old.unionByName(rows).groupBy("table_name", "release_id", "ano", "ref_key", "day").agg(F.sum("n").alias("n"))
    probed = _probe(rows, index)
    spans = F.coalesce("spans", F.array().cast("array<struct<a:date,b:date>>"))
    always, never = F.lit(ALWAYS).cast("date"), F.lit(OPEN).cast("date")
    holds = lambda s: F.coalesce(
        (s["a"] <= F.col("day")) & (F.col("day") < s["b"]), (s["a"] == always) & (s["b"] == never)
    )
    later = lambda side: F.array_min(F.transform(F.filter(spans, lambda s: s[side] > F.col("day")), lambda s: s[side]))
    resolved, removed = later("a"), later("b")
    opened = ~F.exists(spans, holds)
    state = probed.select(
        "table_name", "release_id", "ano", "ref_key", "day", "n", opened.alias("opened"),
        F.when(opened, resolved).alias("resolved_on"),
        F.when(removed < never, removed).alias("removed_on"),
        spans.alias("spans"),
    )
    return state if carried is None else state.unionByName(carried)


class PendingStore:
    """The state over batches in ``path``: the references, and the parent index they were last probed
    with. One marker commits both, so a batch that is run again counts once, also after a restart."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, self.path)
        self.last = (self.log.latest() or (-1, {}))[0]

    def _read(self, kind: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/{kind}-{self.last}") if self.last >= 0 else None

    def state(self) -> DataFrame:
        return self._read("state")

    def advance(self, references: DataFrame, parents: DataFrame, batch: int) -> None:
        """``references`` are new, ``parents`` all that are known now; references of keys whose parents
        are as they were are carried over."""
        if batch <= self.last:
            return
        index = cut(parent_index(parents), "index", f"{self.path}/index-{batch}")
        known = self._read("index")
        changed = changed_keys(known, index) if known is not None else None
        cut(advance(self._read("state"), references, index, changed), "state", f"{self.path}/state-{batch}")
        before, self.last = self.last, batch
        self.log.commit(batch, {})
        for kind in ("index", "state"):
            if before >= 0:
                drop_path(self.spark, f"{self.path}/{kind}-{before}")


def as_known(parents: DataFrame, day) -> DataFrame:
    """The parent rows that had been told by the end of ``day``: those that began by then, and of their
    ends only those that had come."""
    told = F.lit(day).cast("date")
    return parents.where(F.col("valid_from").isNull() | (F.col("valid_from") <= told)).withColumn("valid_to", F.when(F.col("valid_to") <= told, F.col("valid_to")))


def replay(references: DataFrame, parents: DataFrame, batches: int = 2) -> PendingStore:
    """A new store that a history went through in ``batches`` spans of the references' days, each with
    the parents known at its end and the last with all; references without a day come with the last."""
    spark = references.sparkSession
    store = PendingStore(spark, new_table_path(spark, "pending"))
    span = references.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    if span["a"] is None:
        batches = 1
    ends = [span["a"] + (span["b"] - span["a"]) * (k + 1) // batches for k in range(batches - 1)]
    after = F.lit(True)
    for k, end in enumerate(ends):
        upto = F.coalesce(F.col("day") <= F.lit(end), F.lit(False))
        store.advance(references.where(after & upto), as_known(parents, end), k)
        after = ~upto
    store.advance(references.where(after), parents, batches - 1)
    return store


def found(state: DataFrame) -> DataFrame:
    """The references that were orphans on their day."""
    return state.where("opened").select("table_name", "release_id", "ano", "ref_key").distinct()


def snapshots(state: DataFrame, days: list[str]) -> DataFrame:
    """Open orphans per table, period and snapshot day: references that had arrived and whose parent
    did not exist on that day."""
    day = F.explode(F.array(*[F.lit(d).cast("date") for d in days])).alias("snapshot_day")
    at = state.select("table_name", "ano", "ref_key", "day", "n", "spans", day).where(F.col("day") <= F.col("snapshot_day"))
    absent = ~F.exists("spans", lambda s: (s["a"] <= F.col("snapshot_day")) & (F.col("snapshot_day") < s["b"]))
    return at.where(absent).groupBy("table_name", "ano", "snapshot_day").agg(
        F.sum("n").alias("open_references"), F.countDistinct("ref_key").alias("open_keys")
    )
