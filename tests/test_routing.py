import datetime as dt
import uuid

import pytest

from tessera.streaming import late_state, routing

BASE = dt.datetime(2025, 1, 1, 12)
ENVELOPE = "message_id string, payload binary, publish_time timestamp, ingestion_time timestamp, correlation_id string"


def event(**change):
    return {
        "schema_version": "1.0", "event_id": str(uuid.UUID(int=7)), "event_type": "municipal_literacy_rate.updated", "simulation": True,
        "event_time": "2025-01-01T12:00:00+00:00", "ano": 2024, "id_municipio": "3550308", "rede": "municipal", "taxa_alfabetizacao": 61.5,
        "participacao": None, "producer": "p", "correlation_id": "c",
    } | change


def envelopes(spark, payloads):
    return spark.createDataFrame([(f"m{i}", p, BASE, BASE, "attribute") for i, p in enumerate(payloads)], ENVELOPE)


def test_binary_round_trip_and_damage():
    for e in (event(), event(participacao=90.25, ano=-3), event(producer="é" * 70)):
        assert routing.decode_event(routing.encode_event(e)) == e
    data = routing.encode_event(event())
    assert [routing.decode_event(x) for x in (data[:-1], data + b"x", b"", None, b"\xff" * 30)] == [None] * 5
    for bad in (event(extra=1), event(simulation="yes")):
        with pytest.raises(ValueError, match="."):
            routing.encode_event(bad)


def test_each_rule_rejects(spark):
    bad = [
        {"ano": 1999}, {"ano": 2101}, {"id_municipio": "355030"}, {"id_municipio": "0000000"}, {"taxa_alfabetizacao": 100.01}, {"participacao": -0.01},
        {"simulation": False}, {"event_time": "2025-01-01T12:00:00-03:00"}, {"event_time": "2025-01-01T12:00:00"}, {"rede": "federal"}, {"event_id": "x"},
        {"producer": ""}, {"producer": "p" * 81}, {"correlation_id": ""}, {"correlation_id": "c" * 129}, {"schema_version": "2.0"}, {"event_type": "other"},
        {"taxa_alfabetizacao": float("nan")},
    ]
    good = [{}, {"participacao": 100.0}, {"event_time": "2025-01-01T12:00:00Z"}, {"ano": 2000}, {"taxa_alfabetizacao": 0.0}]
    rows = routing.route(envelopes(spark, [routing.encode_event(event(**c)) for c in bad + good])).collect()
    assert [r["valid"] for r in sorted(rows, key=lambda r: int(r["message_id"][1:]))] == [False] * len(bad) + [True] * len(good)


def test_drained_stream_has_one_outcome_each(spark, tmp_path):
    payloads = [routing.encode_event(event(event_id=str(uuid.UUID(int=i)), taxa_alfabetizacao=60 + i / 10)) for i in range(8)] + [routing.encode_event(event(id_municipio="0000000")), b"rubbish"]
    frame = envelopes(spark, payloads)
    for k in range(2):
        frame.where(f"substring(message_id, 2) % 2 = {k}").write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    routing.drain(source, str(tmp_path / "valid"), str(tmp_path / "bad"), str(tmp_path / "checkpoint"))
    valid, bad = spark.read.parquet(str(tmp_path / "valid")), spark.read.parquet(str(tmp_path / "bad"))
    assert valid.count() == 8 and bad.count() == 2 and "payload" not in bad.columns
    assert {r["correlation_id"] for r in bad.collect()} == {"attribute"}
    assert str(valid.where("message_id = 'm3'").first()["taxa_alfabetizacao"]) == "60.300000000"


def test_stream_keeps_one_delivery_within_the_watermark(spark, tmp_path):
    rows = [("a", BASE), ("a", BASE + dt.timedelta(hours=1)), ("b", BASE)]
    spark.createDataFrame(rows, "message_id string, publish_time timestamp").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("message_id string, publish_time timestamp").parquet(str(tmp_path / "in"))
    query = late_state.within_watermark(source).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert sorted(r["message_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
