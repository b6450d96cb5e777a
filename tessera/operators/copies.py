"""Messages delivered more than once: a keyed store of the identifiers seen so far.

Every row has identifiers of several kinds; rows that share one are copies, also through others. The
store only ever appends. A batch adds

* ``seen``: each of its identifiers with the first row that has it (by arrival, then row id), its kind
  and event time, sorted by event time;
* ``links``: rows that turned out to be copies, each with the first row of its class as it was then;
* ``drops``: the batch's answer, the rows that the links reveal as copies;

and one numbered marker commits all three. A batch looks up the identifiers it shares with the store
and resolves what is linked. When a later row links two rows that were both kept, the later one of
them is taken back: it comes out as a row to drop.

The watermark lies ``horizon_hours`` behind the latest event time. Identifiers ahead of it are hot:
every batch meets them, and a folder whose identifiers are all behind it is not opened for that.
What lies behind is the archive, read for the late-arrival lookup only: by rows whose own event time
is behind the watermark, over the span of their event times, and by message identifiers, which may
come back with any event time. A feed whose message ids each have one event time can say so
(``timed_messages``); then a batch without late rows reads no archive at all.

Rows are ordered by one number, arrival * 10^19 + row id, so that "the first of a class" is a plain
minimum: it is combined before every shuffle, and an identifier shared by a third of all rows moves
one row per task. Linked rows are resolved by alternating large-star and small-star rounds.

Identifiers are compared by 128 bits of hash (two independent 64-bit hashes with the kind as salt).

Defined cases
* a null identifier links nothing; a row without any is never a copy;
* event ids ignore case; the second kind needs both an event id and a readable event time;
* the copy that arrived first stays, on a tie the smaller row id; a row without arrival comes last;
* the same row delivered again in a later batch (same row id) is itself, not a copy of itself;
* an empty batch changes nothing; further columns of the input are ignored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import HOUR_US, arrival, instant, micros
from tessera.session import CommitLog, cut, drop_path, new_table_path

LAST = (1 << 63) - 1
OLDEST = -(1 << 62)
_SCALE = Decimal(10**19)


def message_rows(stream: DataFrame) -> DataFrame:
    """(row_id, arrival_us, event_us, message key, event key) of the event table."""
    return stream.select(
        F.col("delivery_id").alias("row_id"),
        F.coalesce(micros(arrival()), F.lit(LAST)).alias("arrival_us"),
        micros(instant(F.col("event_time"))).alias("event_us"),
        F.col("message_id"),
        F.lower("event_id").alias("event_id"),
    )


def place(arrival_us, row_id) -> F.Column:
    return (arrival_us.cast("decimal(19,0)") * F.lit(_SCALE).cast("decimal(20,0)") + row_id.cast("decimal(19,0)")).cast("decimal(38,0)")


def row_id_of(order) -> F.Column:
    return F.pmod(order, F.lit(_SCALE).cast("decimal(20,0)")).cast("long")


def identifier_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """(h1, h2, ord, event_us, is_message): one row per row and identifier; columns to ``keep`` after them."""
    order = place(F.col("arrival_us"), F.col("row_id"))

    def key(kind, present, *parts):
        return F.when(present, F.struct(
            F.xxhash64(F.lit(kind), *parts).alias("h1"), F.xxhash64(*parts, F.lit(kind + "2")).alias("h2"), F.lit(kind == "message").alias("is_message")
        ))

    keys = F.array_compact(
        F.array(
            key("message", F.col("message_id").isNotNull(), "message_id"),
            key("event", F.col("event_id").isNotNull() & F.col("event_us").isNotNull(), "event_id", "event_us"),
        )
    )
    return rows.select(order.alias("ord"), "event_us", *keep, F.explode(keys).alias("key")).select("key.h1", "key.h2", "ord", "event_us", "key.is_message", *keep)


def first_seen(identifiers: DataFrame) -> DataFrame:
    """(h1, h2, first, n, event_us, is_message): the first row of each identifier and the number of rows."""
    return identifiers.groupBy("h1", "h2").agg(
        F.min("ord").alias("first"), F.count(F.lit(1)).alias("n"), F.max("event_us").alias("event_us"), F.max("is_message").alias("is_message")
    )


def star_edges(identifiers: DataFrame, seen: DataFrame) -> DataFrame:
    """Each row that shares an identifier with an earlier one, with that identifier's first row."""
    shared = seen.where(F.col("n") > 1).select("h1", "h2", "first")
    return (
        identifiers.select("h1", "h2", "ord").join(shared, ["h1", "h2"]).where(F.col("ord") != F.col("first"))
        .select(F.col("ord").alias("u"), F.col("first").alias("v")).distinct()
    )


def resolve(edges: DataFrame, label: str = "links") -> DataFrame:
    """(row, root): for every vertex of ``edges`` but the smallest of its component, that smallest.

    Large-star joins each neighbour larger than a vertex to the smallest it knows, small-star each
    smaller one; alternated, they end in stars. A vertex's minimum is aggregated and joined back, its
    neighbours are never gathered.
    """
    spark = edges.sparkSession
    big, small = F.greatest("u", "v"), F.least("u", "v")
    path = new_table_path(spark, label)
    current = cut(edges.where(F.col("u") != F.col("v")).select(big.alias("u"), small.alias("v")).distinct(), label, path)
    while not _are_stars(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        next_path = new_table_path(spark, label)
        current = cut(joined.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), label, next_path)
        drop_path(spark, path)
        path = next_path
    return current.select(F.col("u").alias("row"), F.col("v").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v), u > v, leads from a vertex of no other edge to the centre of its star;
    then the stars are the components, for the rounds keep what is connected."""
    counted = edges.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("u").alias("tips")).first()
    if counted["n"] != counted["tips"]:
        return False
    centres = edges.select(F.col("v").alias("u")).distinct()
    return edges.select("u").join(centres, "u", "left_semi").limit(1).count() == 0


def replay(rows: DataFrame, batches: int = 2, horizon_hours: int = 72) -> DataFrame:
    """The rows to drop of a stored stream, replayed through a new store in ``batches`` slices of its
    time of arrival (equal spans of time; rows without arrival come with the last)."""
    spark = rows.sparkSession
    store = MessageStore(spark, new_table_path(spark, "store"), horizon_hours)
    span = rows.where(F.col("arrival_us") < LAST).agg(F.min("arrival_us").alias("a"), F.max("arrival_us").alias("b")).first()
    low, high = (span["a"], span["b"]) if span["a"] is not None else (0, 0)
    width = (high - low) // batches + 1
    late = F.call_function("div", F.col("arrival_us") - F.lit(low), F.lit(width))
    slices = rows.withColumn("slice", F.least(late, F.lit(batches - 1)).cast("int"))
    path = new_table_path(spark, "identifiers")
    written = identifier_rows(slices, "slice")  # read twice for each slice, so hashed and written once
    written.write.partitionBy("slice").parquet(path)
    identifiers = spark.read.schema(written.schema).parquet(path)
    drops = None
    for k in range(batches):
        part = store.process_identifiers(identifiers.where(F.col("slice") == k), k)
        drops = part if drops is None else drops.unionByName(part)
    drop_path(spark, path)
    return drops


class MessageStore:
    """State of ``process`` over batches in ``path``, which survives a restart. Batches are numbered
    upwards; one that was committed before gives its stored answer again."""

    def __init__(self, spark, path: str, horizon_hours: int = 72, timed_messages: bool = False):
        self.spark, self.path, self.horizon_us, self.timed_messages = spark, path.rstrip("/"), horizon_hours * HOUR_US, timed_messages
        self.log = CommitLog(spark, self.path)
        latest = self.log.latest()
        #: last batch; latest event time; of each batch that may still be hot its latest event time
        self.last, self.version = latest if latest else (-1, {"high": None, "first": None, "hot": {}})

    def _read(self, kind: str, batches: list[int], schema: str) -> DataFrame:
        paths = [f"{self.path}/batch-{k}/{kind}" for k in batches]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _seen(self, batches: list[int]) -> DataFrame:
        return self._read("seen", batches, "h1 long, h2 long, first decimal(38,0), n long, event_us long, is_message boolean")

    def _batches(self) -> list[int]:
        return list(range(self.version["first"], self.last + 1)) if self.last >= 0 else []

    def _behind(self) -> F.Column:
        """Whether an event time lies behind the watermark; none does, so it is not hot."""
        watermark = (OLDEST if self.version["high"] is None else self.version["high"]) - self.horizon_us
        return F.coalesce(F.col("event_us") < F.lit(watermark), F.lit(True))

    def known(self, fresh: DataFrame) -> DataFrame | None:
        """What of the store a batch meets: (u, root), its rows with the stored first rows of their identifiers."""
        if self.last < 0:
            return None
        behind = self._behind()
        late = fresh.where(behind).agg(F.count(F.lit(1)).alias("n"), F.min("event_us").alias("since")).first()
        # an event key holds its event time, so one ahead of the watermark has no like behind it
        met = ~behind
        if not self.timed_messages:
            met = met | F.col("is_message")
        if late["n"]:
            met = met | F.col("event_us").isNull() | F.coalesce(F.col("event_us") >= F.lit(late["since"]), F.lit(False))
        only_hot = self.timed_messages and not late["n"]
        stored = self._seen([int(k) for k in self.version["hot"]] if only_hot else self._batches()).where(met)
        stored = stored.select("h1", "h2", F.col("first").alias("root"))
        return fresh.select("h1", "h2", F.col("first").alias("u")).join(stored, ["h1", "h2"]).select("u", "root").distinct()

    def roots(self, rows: DataFrame, links: DataFrame) -> DataFrame:
        """Of each row in ``rows`` (with a column ``root``) the first of its class as it is now: links are
        followed until none leads on. A class that lost its first row k times takes k + 1 steps."""
        to = links.select(F.col("row").alias("root"), F.col("root").alias("to"))
        while True:
            stepped = cut(rows.join(to, "root", "left").withColumn("moved", F.col("to").isNotNull()).withColumn("root", F.coalesce("to", "root")).drop("to"), "roots")
            rows = stepped.drop("moved")
            if not stepped.where("moved").limit(1).count():
                return rows

    def process(self, rows: DataFrame, batch: int) -> DataFrame:
        """Apply one batch and return the rows to drop that it reveals: copies among its own rows and
        rows kept earlier that it links to earlier ones."""
        return self.process_identifiers(identifier_rows(rows), batch)

    def process_identifiers(self, identifiers: DataFrame, batch: int) -> DataFrame:
        at = f"{self.path}/batch-{batch}"
        if batch <= self.last:
            return self._read("drops", [batch], "row_id long")
        fresh = cut(first_seen(identifiers).sortWithinPartitions("event_us"), "seen", f"{at}/seen")
        edges = star_edges(identifiers, fresh)
        links_schema = "row decimal(38,0), root decimal(38,0)"
        old_links = self._read("links", self._batches(), links_schema)
        met = self.known(fresh)
        if met is not None:
            reached = self.roots(met, old_links)
            edges = edges.unionByName(reached.select("u", F.col("root").alias("v")).where(F.col("u") != F.col("v")))
        links = resolve(edges)
        if self.last >= 0:  # a row that is stored again is linked already
            links = links.join(old_links.select("row"), "row", "left_anti")
        links = cut(links, "links", f"{at}/links")
        drops = cut(links.select(row_id_of(F.col("row")).alias("row_id")), "drops", f"{at}/drops")
        self._commit(batch, fresh.agg(F.max("event_us")).first()[0])
        return drops

    def _commit(self, batch: int, high: int | None) -> None:
        """Batches are one run of numbers; those skipped are written empty, so that reading needs no list."""
        first = batch if self.version["first"] is None else self.version["first"]
        for k in range(self.last + 1 if self.last >= 0 else batch, batch):
            self._seen([]).write.mode("overwrite").parquet(f"{self.path}/batch-{k}/seen")
            for kind, schema in (("links", "row decimal(38,0), root decimal(38,0)"), ("drops", "row_id long")):
                self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self.path}/batch-{k}/{kind}")
        latest = max([h for h in (high, self.version["high"]) if h is not None], default=None)
        hot = self.version["hot"] | ({} if high is None else {str(batch): high})
        hot = {k: h for k, h in hot.items() if h >= latest - self.horizon_us}
        version = {"high": latest, "first": first, "hot": hot}
        self.log.commit(batch, version)
        self.last, self.version = batch, version
