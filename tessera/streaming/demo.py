"""A bounded run of the event stream: produced, published, delivered with repeats, settled and reported."""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.columns import instant
from tessera.operators import relational
from tessera.streaming.routing import EVENT_FIELDS, encode_event, quarantined_rows, route

ENVELOPE = "message_id string, payload binary, publish_time timestamp, ingestion_time timestamp, correlation_id string"
_REFUSED = (ValueError, KeyError, TypeError, AttributeError, struct.error)


def produced(templates: Iterable[dict], year: int, begins: dt.datetime, correlation_id: str) -> list[dict]:
    """Events of one run: the templates with its year and correlation, a second apart."""
    return [
        template | {"ano": year, "event_time": (begins + dt.timedelta(seconds=k)).isoformat(), "correlation_id": correlation_id}
        for k, template in enumerate(templates, start=1)
    ]


def publish(spark: SparkSession, events: Iterable[dict], begins: dt.datetime, delay_ms: int = 250) -> tuple[DataFrame, int]:
    """(envelopes, refused): events that are no records of the schema are refused before they are sent."""
    rows, refused = [], 0
    for k, event in enumerate(events, start=1):
        try:
            payload = encode_event(event)
        except _REFUSED:
            refused += 1
            continue
        sent = begins + dt.timedelta(seconds=k)
        rows.append((f"message-{k:02d}", bytearray(payload), sent, sent + dt.timedelta(milliseconds=delay_ms), event["correlation_id"]))
    return spark.createDataFrame(rows, ENVELOPE), refused


def encoded(columns: dict[str, Column]) -> Column:
    """The binary record of each row, null for one that is no record. ``columns`` by the fields' names."""

    @F.pandas_udf("binary")
    def encode(rows: pd.DataFrame) -> pd.Series:
        out = []
        for row in rows.to_dict("records"):
            try:
                out.append(encode_event({k: None if pd.isna(v) else v for k, v in row.items()}))
            except _REFUSED:
                out.append(None)
        return pd.Series(out)

    types = {"string": "string", "boolean": "boolean", "long": "long", "double": "double", "optional double": "double"}
    return encode(F.struct(*[columns[name].cast(types[kind]).alias(name) for name, kind in EVENT_FIELDS]))


def settle(envelopes: DataFrame) -> dict[str, DataFrame]:
    """``raw``: the first delivery of each message; ``valid``: the latest version of each event;
    ``audit``: the versions it replaced, with the message that stands for them; ``quarantine``; and
    ``latency``: seconds from publishing to ingestion of every valid message, replaced ones too."""
    rest = [c for c in envelopes.columns if c != "message_id"]
    first = F.min(F.struct("ingestion_time", "publish_time", *[F.col(c).alias(f"k_{c}") for c in rest])).alias("first")
    raw = envelopes.groupBy("message_id").agg(first).select("message_id", *[F.col(f"first.k_{c}").alias(c) for c in rest])
    routed = route(raw)
    good = routed.where("valid").withColumn("at", instant(F.col("event_time")))
    kept = relational.latest(good, ["event_id"], ["at", "publish_time", "ingestion_time", "message_id"])
    canonical = kept.select("event_id", F.col("message_id").alias("canonical_message_id"))
    return {
        "raw": raw, "valid": kept.drop("at", "valid", "payload"), "quarantine": quarantined_rows(routed),
        "audit": good.join(canonical, "event_id").where(F.col("message_id") != F.col("canonical_message_id")).select("message_id", "canonical_message_id", "event_id"),
        "latency": good.select(((F.unix_micros("ingestion_time") - F.unix_micros("publish_time")) / F.lit(1e6)).alias("seconds")),
    }


def report(envelopes: DataFrame, refused: int = 0) -> dict:
    """Counts of a run; the 95th percentile of the latency is exact, and 0 if nothing was valid."""
    parts = settle(envelopes)
    counts = {name: parts[name].count() for name in ("raw", "valid", "audit", "quarantine")}
    p95 = parts["latency"].agg(F.coalesce(F.percentile("seconds", 0.95), F.lit(0.0))).first()[0]
    return {
        "raw_message_ids": counts["raw"], "valid_event_ids": counts["valid"], "duplicate_audit": counts["audit"], "quarantine": counts["quarantine"],
        "schema_rejected": refused, "redeliveries_tolerated": envelopes.count() - counts["raw"], "p95_latency_seconds": p95,
    }


def write_lines(envelopes: DataFrame, path: str) -> None:
    """The settled tables as JSON lines; a repeated run replaces them."""
    for name in ("valid", "audit", "quarantine"):
        settle(envelopes)[name].write.mode("overwrite").json(f"{path}/{name}")


def archive(envelopes: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """A second sink of the stream: every delivery as it came, with its attributes, a file set for each
    interval. Without an interval it ends when what is there has been written."""
    writer = envelopes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
