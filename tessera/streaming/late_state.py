"""The multiset state of late events, kept over batches of arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import late_events
from tessera.session import CommitLog, cut, drop_path, new_table_path

_STATE = "period int, revision int, value decimal(28,9), n long"
_LOG = "row_id long, period int, value decimal(28,9), fate string, revision int, delta long"


class MultisetStore:
    """Counts of values by period and revision, and the log of what came after a period's end.

    A batch appends the adjustments that its rows make to the counts, and its late rows; one marker
    commits both, so a batch that is run again counts once, also after a restart. What a batch costs
    does not depend on the batches before it; ``compact`` adds up what they left.
    """

    def __init__(self, spark, path: str, policy=late_events.LatePolicy()):
        self.spark, self.path, self.policy = spark, path.rstrip("/"), policy
        self.log = CommitLog(spark, self.path)
        self.number, self.version = self.log.latest() or (-1, {"parts": [], "batches": []})

    @property
    def last(self) -> int:
        """The last batch applied."""
        return max(self.version["batches"], default=-1)

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def state(self) -> DataFrame:
        """(period, revision, value, n), revision 0 for what was there when the period closed."""
        return late_events.merge_multisets(self._read([f"{self.path}/{p}" for p in self.version["parts"]], _STATE))

    def corrections(self) -> DataFrame:
        """Every row that came at or after the end of its period, with what it did to the counts."""
        return self._read([f"{self.path}/late-{k}" for k in self.version["batches"]], _LOG)

    def _commit(self, version: dict) -> None:
        self.log.commit(self.number + 1, version)
        self.number, self.version = self.number + 1, version

    def apply(self, rows: DataFrame, batch: int) -> None:
        """Rows as ``late_events.stream_rows`` gives them."""
        if batch > self.last:
            self.apply_adjustments(late_events.adjustments(rows, self.policy), batch)

    def apply_adjustments(self, adjusted: DataFrame, batch: int) -> None:
        if batch <= self.last:
            return
        counts = late_events.multiset(adjusted, "revision").select("period", "revision", "value", "n")
        cut(counts, "counts", f"{self.path}/counts-{batch}")
        late = adjusted.where(F.col("fate") != late_events.ON_TIME)
        cut(late.select("row_id", "period", "value", "fate", "revision", "delta"), "late", f"{self.path}/late-{batch}")
        self._commit({"parts": [*self.version["parts"], f"counts-{batch}"], "batches": [*self.version["batches"], batch]})

    def compact(self) -> None:
        """One table of counts for those of all batches so far."""
        name, old = f"compact-{self.number + 1}", self.version["parts"]
        cut(self.state(), "counts", f"{self.path}/{name}")
        self._commit({"parts": [name], "batches": self.version["batches"]})
        for part in old:
            drop_path(self.spark, f"{self.path}/{part}")

    def aggregates(self) -> DataFrame:
        return late_events.aggregates(self.state().groupBy("period", "value").agg(F.sum("n").alias("n")))

    def run(self, stream: DataFrame, checkpoint: str, timeout_s: int = 300) -> None:
        """Drain a streaming read of the event table into the state."""
        apply = lambda batch, batch_id: self.apply(late_events.stream_rows(batch), batch_id)
        query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            if not query.awaitTermination(timeout_s):
                raise TimeoutError("the stream was not drained in time")
        finally:
            query.stop()


def replay(rows: DataFrame, batches: int = 3, policy=late_events.LatePolicy()) -> MultisetStore:
    """A new store that a stored stream went through in ``batches`` slices of its time of arrival (equal
    spans of time). The rows are read and admitted once, and written by slice."""
    spark = rows.sparkSession
    store = MultisetStore(spark, new_table_path(spark, "late"), policy)
    adjusted = late_events.adjustments(rows, policy)
    span = adjusted.agg(F.min("arrival_us").alias("a"), F.max("arrival_us").alias("b")).first()
    low, high = (span["a"], span["b"]) if span["a"] is not None else (0, 0)
    late = F.call_function("div", F.col("arrival_us") - F.lit(low), F.lit((high - low) // batches + 1))
    path = new_table_path(spark, "adjusted")
    written = adjusted.select("row_id", "period", "value", "fate", "revision", "delta", late.cast("int").alias("slice"))
    written.write.partitionBy("slice").parquet(path)
    sliced = spark.read.schema(written.schema).parquet(path)
    for k in range(batches):
        store.apply_adjustments(sliced.where(F.col("slice") == k), k)
    drop_path(spark, path)
    return store


def within_watermark(stream: DataFrame, hours: int = 72) -> DataFrame:
    """The first of the deliveries of each message id in a stream, by the engine's own state store; its
    identifiers expire with the watermark (see ``operators.copies`` for what arrives later still)."""
    return stream.withWatermark("publish_time", f"{hours} hours").dropDuplicatesWithinWatermark(["message_id"])
