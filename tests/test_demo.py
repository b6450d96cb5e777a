import datetime as dt
import json
import uuid

from tessera.streaming import demo
from tessera.streaming.routing import EVENT_TYPE

BEGINS = dt.datetime(2024, 2, 3, 4, 5, 6, tzinfo=dt.timezone.utc)


def template(k, **changed):
    return {
        "schema_version": "1.0", "event_id": str(uuid.UUID(int=k)), "event_type": EVENT_TYPE, "simulation": True, "event_time": "", "ano": 0, "id_municipio": f"{3550000 + k}",
        "rede": "publica", "taxa_alfabetizacao": 50.5, "participacao": None, "producer": "tests", "correlation_id": "",
    } | changed


def envelopes(spark):
    """Ten events, of which one is a version of another and one has an impossible rate; one that is no
    record at all; and the first is delivered twice."""
    records = [*[template(k) for k in range(8)], template(3, taxa_alfabetizacao=60.0), template(9, taxa_alfabetizacao=101.0), {"unknown": 1}]
    sent, refused = demo.publish(spark, demo.produced(records, 2024, BEGINS, "local-2024"), BEGINS)
    return sent.unionByName(sent.where("message_id = 'message-01'").withColumn("ingestion_time", sent["ingestion_time"] + dt.timedelta(seconds=30))), refused


def test_a_run_is_counted_and_repeatable(spark, tmp_path):
    sent, refused = envelopes(spark)
    got = demo.report(sent, refused)
    assert got == {
        "raw_message_ids": 10, "valid_event_ids": 8, "duplicate_audit": 1, "quarantine": 1, "schema_rejected": 1, "redeliveries_tolerated": 1, "p95_latency_seconds": 0.25,
    }
    parts = demo.settle(sent)
    assert [tuple(r) for r in parts["audit"].collect()] == [("message-04", "message-09", str(uuid.UUID(int=3)))]
    for _ in range(2):
        demo.write_lines(sent, str(tmp_path))
    lines = [json.loads(x) for f in (tmp_path / "valid").glob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == len({x["event_id"] for x in lines}) == 8 and {(x["ano"], x["rede"]) for x in lines} == {(2024, "publica")}
    assert demo.report(sent.limit(0)) == dict.fromkeys(got, 0) | {"p95_latency_seconds": 0.0}


def test_the_archive_keeps_every_delivery(spark, tmp_path):
    sent, _ = envelopes(spark)
    sent.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(sent.schema).parquet(str(tmp_path / "in"))
    query = demo.archive(stream, str(tmp_path / "raw"), str(tmp_path / "checkpoint"), every=None)
    assert query.awaitTermination(60) and spark.read.parquet(str(tmp_path / "raw")).count() == 11
