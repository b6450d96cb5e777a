"""From event envelopes to valid rows and quarantine, in micro-batches that are applied once.

Envelope: message_id, payload (binary), publish_time, ingestion_time, correlation_id (attribute).
Every envelope has exactly one outcome. Quarantined rows keep a fingerprint of the payload, never the
payload itself.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import instant

# The fields of the event record, in the order of their binary encoding.
EVENT_FIELDS = (
    ("schema_version", "string"), ("event_id", "string"), ("event_type", "string"), ("simulation", "boolean"),
    ("event_time", "string"), ("ano", "long"), ("id_municipio", "string"), ("rede", "string"),
    ("taxa_alfabetizacao", "double"), ("participacao", "optional double"), ("producer", "string"), ("correlation_id", "string"),
)
EVENT_TYPE, SCHEMA_VERSION, NETWORKS = "municipal_literacy_rate.updated", "1.0", ("total", "estadual", "municipal", "publica")
MISSING_MESSAGE, INVALID_REASON = "missing-message-id", "AVRO_OR_SEMANTIC_INVALID"

_SQL_TYPE = {"string": "string", "boolean": "boolean", "long": "long", "double": "double", "optional double": "double"}
DECODED = ", ".join(f"{n} {_SQL_TYPE[t]}" for n, t in EVENT_FIELDS)


def _long(value: int) -> bytes:
    zigzag, out = (value << 1) ^ (value >> 63), bytearray()
    while zigzag > 0x7F:
        out.append(zigzag & 0x7F | 0x80)
        zigzag >>= 7
    return bytes(out) + bytes([zigzag])


def encode_event(event: dict) -> bytes:
    """Binary Avro of one event without a header; an unknown, missing or mistyped field is refused."""
    if set(event) - {n for n, _ in EVENT_FIELDS}:
        raise ValueError("unknown field")
    out = []
    for name, kind in EVENT_FIELDS:
        value = event.get(name) if kind.startswith("optional") else event[name]
        if kind == "string":
            body = value.encode()
            out.append(_long(len(body)) + body)
        elif kind == "boolean":
            if not isinstance(value, bool):
                raise ValueError(name)
            out.append(b"\x01" if value else b"\x00")
        elif kind == "long":
            out.append(_long(int(value)))
        elif kind == "double":
            out.append(struct.pack("<d", value))
        else:
            out.append(_long(0) if value is None else _long(1) + struct.pack("<d", value))
    return b"".join(out)


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise ValueError("truncated")
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        shift = value = 0
        while True:
            byte = self.take(1)[0]
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return (value >> 1) ^ -(value & 1)
            shift += 7
            if shift > 63:
                raise ValueError("long")

    def value(self, kind: str):
        if kind == "string":
            return self.take(self.long()).decode()
        if kind == "boolean":
            return {0: False, 1: True}[self.take(1)[0]]
        if kind == "long":
            return self.long()
        if kind == "double":
            return struct.unpack("<d", self.take(8))[0]
        return {0: lambda: None, 1: lambda: self.value("double")}[self.long()]()


def decode_event(payload: bytes | None) -> dict | None:
    """The event of a payload, or None if it is not exactly one record."""
    if payload is None:
        return None
    reader = _Reader(bytes(payload))
    try:
        event = {name: reader.value(kind) for name, kind in EVENT_FIELDS}
    except (ValueError, KeyError, UnicodeDecodeError):
        return None
    return event if reader.at == len(reader.data) else None


def decoder():
    @F.pandas_udf(DECODED)
    def decode(payloads: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [n for n, _ in EVENT_FIELDS]
        for batch in payloads:
            yield pd.DataFrame([decode_event(p) or dict.fromkeys(names) for p in batch], columns=names)

    return decode


def semantic_rules(rows: DataFrame) -> Column:
    """What an event must be beyond its structure; rules on columns the rows lack do not apply."""
    col = F.col
    rules = [
        col("event_id").rlike(r"\A(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"),
        col("simulation"),
        instant(col("event_time")).isNotNull() & col("event_time").rlike(r"(Z|[+-]00:?00)\z"),
        col("ano").between(2000, 2100),
        col("id_municipio").rlike(r"\A[0-9]{7}\z") & (col("id_municipio") != "0000000"),
        col("rede").isin(*NETWORKS),
        col("taxa_alfabetizacao").between(0, 100),
        col("participacao").isNull() | col("participacao").between(0, 100),
        F.length("correlation_id").between(1, 128),
    ]
    optional = {
        "schema_version": col("schema_version") == SCHEMA_VERSION, "event_type": col("event_type") == EVENT_TYPE, "producer": F.length("producer").between(1, 80)
    }
    rules += [rule for name, rule in optional.items() if name in rows.columns]
    out = rules[0]
    for rule in rules[1:]:
        out = out & rule
    return F.coalesce(out, F.lit(False))


def route(envelopes: DataFrame) -> DataFrame:
    """Envelopes with their decoded event and the column ``valid``."""
    named = envelopes.withColumn("message_id", F.coalesce("message_id", F.lit(MISSING_MESSAGE)))
    decoded = named.select("message_id", "payload", "publish_time", "ingestion_time", F.col("correlation_id").alias("attribute_correlation"), decoder()("payload").alias("event"))
    flat = decoded.select("message_id", "payload", "publish_time", "ingestion_time", "attribute_correlation", "event.*")
    return flat.withColumn("valid", semantic_rules(flat))


def staged_rows(routed: DataFrame) -> DataFrame:
    """Valid rows of the stream table; rates become decimals by their spelling."""
    decimal = lambda c: F.col(c).cast("string").cast("decimal(28,9)")
    return routed.where("valid").select(
        "event_id", "message_id", "event_time", "publish_time", "ingestion_time", "ano", "id_municipio", "rede",
        decimal("taxa_alfabetizacao").alias("taxa_alfabetizacao"), decimal("participacao").alias("taxa_participacao"), "correlation_id", "simulation",
    )


def quarantined_rows(routed: DataFrame) -> DataFrame:
    return routed.where(~F.col("valid")).select(
        "message_id", F.lit(INVALID_REASON).alias("reason"), F.sha2("payload", 256).alias("payload_fingerprint"), F.col("attribute_correlation").alias("correlation_id"), "ingestion_time"
    )


def drain(envelopes: DataFrame, valid_path: str, quarantine_path: str, checkpoint: str, timeout_s: int = 120) -> None:
    """Run a stream of envelopes to its end. Each micro-batch replaces its own folder in both sinks,
    so a batch that is run again leaves no copies. Not ending in time is an error, and the query is
    stopped in any case."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        routed = route(batch).persist()
        try:
            staged_rows(routed).write.mode("overwrite").parquet(f"{valid_path}/batch={batch_id}")
            quarantined_rows(routed).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        finally:
            routed.unpersist()

    query = envelopes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        if not query.awaitTermination(timeout_s):
            raise TimeoutError("the stream was not drained in time")
    finally:
        query.stop()
