"""Current state of a table from a feed of inserts, updates and deletes, with equality deletes.

Every change has a sequence, total and independent of arrival: ``(event instant, publish time,
delivery id)``. The writer appends two kinds of rows separately: data rows (inserts and updates,
which are the same here: an update also replaces what came before it) and equality-delete rows
``(key, sequence)``. A reader keeps the data rows for which no delete of the same key has a later
sequence. Both sides are compacted to their latest row per key before they are shuffled; a key that
holds a third of the feed moves one row per task.

Defined cases
* null parts of a key are a value like any other (null equals null);
* the first letter of the operation decides, in either case; a null, empty or other operation is an
  upsert of nothing and is ignored: such rows are returned by ``unknown_changes``;
* an unreadable event time or a null publish time is older than any other;
* repeated rows are the same change; ties are broken by the delivery id, which is unique;
* an empty feed gives an empty table; further columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import instant, micros
from tessera.session import CommitLog, cut

KEYS = ("ano", "id_municipio", "rede")
OLDEST = -(1 << 62)


def change_rows(stream: DataFrame) -> DataFrame:
    """The feed in the operator's terms: key columns, sequence, operation and value."""
    first = F.upper(F.substring(F.trim("change_op"), 1, 1))
    return stream.select(
        *KEYS,
        F.coalesce(micros(instant(F.col("event_time"))), F.lit(OLDEST)).alias("seq_event"),
        F.coalesce(micros(F.col("publish_time")), F.lit(OLDEST)).alias("seq_publish"),
        F.col("delivery_id").alias("seq_id"),
        first.alias("op"),
        F.col("taxa_alfabetizacao").alias("value"),
    )


def _sequence() -> F.Column:
    return F.struct("seq_event", "seq_publish", "seq_id")


def data_rows(changes: DataFrame, keys=KEYS) -> DataFrame:
    """Appended rows: for each key the upsert with the latest sequence of what is appended."""
    return (
        changes.where(F.col("op").isin("I", "U"))
        .groupBy(*keys)
        .agg(F.max(F.struct("seq_event", "seq_publish", "seq_id", "value")).alias("row"))
        .select(*keys, F.struct("row.seq_event", "row.seq_publish", "row.seq_id").alias("seq"), F.col("row.value").alias("value"))
    )


def delete_rows(changes: DataFrame, keys=KEYS) -> DataFrame:
    """Equality deletes: for each deleted key the latest sequence at which it was deleted."""
    return changes.where(F.col("op") == "D").groupBy(*keys).agg(F.max(_sequence()).alias("deleted_at"))


def unknown_changes(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("op").isNull() | ~F.col("op").isin("I", "U", "D"))


def read_current(data: DataFrame, deletes: DataFrame, keys=KEYS) -> DataFrame:
    """Rows of ``data`` that no later equality delete takes away."""
    same_key = reduce(lambda a, b: a & b, [data[k].eqNullSafe(deletes[k]) for k in keys])
    return data.join(deletes, same_key & (deletes["deleted_at"] > data["seq"]), "left_anti")


def current_rows(changes: DataFrame, keys=KEYS) -> DataFrame:
    """The current table of one bounded feed."""
    return read_current(data_rows(changes, keys), delete_rows(changes, keys), keys)


class EqualityDeleteTable:
    """The same over batches: each ``append`` adds one data table and one delete table under ``path``,
    and a marker that names them; batches may come in any order and more than once (a batch id counts
    once), and the table is what it was after a restart."""

    def __init__(self, spark, path: str, keys=KEYS):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)
        self.log = CommitLog(spark, self.path)
        self.number, self.version = self.log.latest() or (-1, {"live": [], "applied": []})

    def _commit(self, live: list[str], applied: list[str]) -> None:
        version = {"live": live, "applied": applied}
        self.log.commit(self.number + 1, version)
        self.number, self.version = self.number + 1, version

    def _write(self, name: str, data: DataFrame, deletes: DataFrame) -> None:
        cut(data, "data", f"{self.path}/data/{name}")
        cut(deletes, "deletes", f"{self.path}/deletes/{name}")

    def append(self, changes: DataFrame, batch_id: str) -> None:
        if batch_id in self.version["applied"]:
            return
        self._write(batch_id, data_rows(changes, self.keys), delete_rows(changes, self.keys))
        self._commit([*self.version["live"], batch_id], [*self.version["applied"], batch_id])

    def _all(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{kind}/{b}" for b in self.version["live"]])

    def read(self) -> DataFrame:
        keys = list(self.keys)
        data = self._all("data").groupBy(*keys).agg(F.max(F.struct("seq", "value")).alias("row")).select(*keys, "row.*")
        deletes = self._all("deletes").groupBy(*keys).agg(F.max("deleted_at").alias("deleted_at"))
        return read_current(data, deletes, self.keys)

    def compact(self, name: str) -> None:
        """Rewrite what is live as one batch. Deletes stay, so that a late upsert older than a delete is
        still refused."""
        deletes = self._all("deletes").groupBy(*self.keys).agg(F.max("deleted_at").alias("deleted_at"))
        self._write(name, self.read(), deletes)
        self._commit([name], self.version["applied"])
