import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest

from tessera.operators import late_events as late
from tessera.streaming import late_state
from tessera.streaming.late_state import MultisetStore

UTC = dt.timezone.utc
SCHEMA = "delivery_id long, event_time string, publish_time timestamp, ingestion_time timestamp, taxa_alfabetizacao decimal(28,9), value string, period string"


def stamp(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def stream(spark, rows):
    """Rows with two further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_fates_at_the_edges(spark):
    rows = [
        (1, "2025-03-01T23:59:59.999999Z", stamp("2025-03-01T23:59:59"), stamp("2025-03-01T23:59:59.999999"), Decimal(1)),
        (2, "2025-03-01T10:00:00+00:00", stamp("2025-03-01T10:00:00"), stamp("2025-03-02T00:00:00"), Decimal(1)),
        (3, "2025-03-01T10:00:00Z", stamp("2025-03-01T10:00:00"), stamp("2025-03-04T10:00:00"), Decimal(1)),
        (4, "2025-03-01T10:00:00Z", stamp("2025-03-01T10:00:00"), stamp("2025-03-04T10:00:00.000001"), Decimal(1)),
        (5, "2025-03-01T23:00:00-03:00", stamp("2025-03-02T23:00:00"), None, None),
        (6, "2025-03-05T10:00:00Z", stamp("2025-03-01T10:00:00"), stamp("2025-03-01T10:00:00"), Decimal(1)),
        (7, None, stamp("2025-03-01T10:00:00"), None, Decimal(1)),
        (8, "2025-03-01T10:00:00Z", None, None, Decimal(1)),
        (9, "soon", stamp("2025-03-01T10:00:00"), None, Decimal(1)),
    ]
    got = {r["row_id"]: r["fate"] for r in late.route(late.stream_rows(stream(spark, rows))).collect()}
    assert got == {1: "on_time", 2: "correction", 3: "correction", 4: "dropped", 5: "on_time", 6: "on_time", 7: "unplaced", 8: "unplaced", 9: "unplaced"}
    store = late_state.replay(late.stream_rows(stream(spark, rows)))
    assert {r["row_id"]: r["delta"] for r in store.corrections().collect()} == {2: 1, 3: 1, 4: 0}
    counts = [tuple(r)[1:] for r in late.correction_counts(store.state(), store.corrections()).collect()]
    assert counts == [(Decimal(1), 1, 2, 1, 3)]


def random_rows(n, seed=1):
    random.seed(seed)
    rows = []
    for i in range(n):
        event = stamp("2025-03-01T00:00:00") + dt.timedelta(minutes=random.randrange(3 * 1440))
        arrived = event + dt.timedelta(hours=random.choice([0, 1, 20, 30, 60, 71, 80]))
        value = random.choice([None, Decimal(random.randrange(0, 500)) / 4])
        rows.append((i, event.isoformat(), arrived, random.choice([None, arrived]), value))
    return rows


def expected(rows):
    days = {}
    for _, event, arrived, _, value in rows:
        e = dt.datetime.fromisoformat(event)
        if arrived - e <= dt.timedelta(hours=72):
            days.setdefault((e.date() - dt.date(1970, 1, 1)).days, []).append(value)
    out = {}
    for day, values in days.items():
        v = [x for x in values if x is not None]
        out[day] = (len(values), len(v), len(set(v)), min(v, default=None), max(v, default=None), float(statistics.median(v)) if v else None)
    return out


def read(df):
    return {r["period"]: (r["n_rows"], r["n_values"], r["n_distinct"], r["min_value"], r["max_value"], r["median_value"]) for r in df.collect()}


@pytest.mark.parametrize("n", [0, 1, 2, 400])
def test_aggregates_against_the_records(spark, n):
    rows = random_rows(n)
    state = late.multiset(late.adjustments(late.stream_rows(stream(spark, rows))))
    assert read(late.aggregates(state)) == expected(rows)


def test_batches_in_any_order_give_the_same(spark, tmp_path):
    rows = random_rows(200, 2)
    for n, k in enumerate((2, 0, 1)):
        store = MultisetStore(spark, str(tmp_path / "state"))  # as after a restart
        assert store.last == n - 1
        batch = late.stream_rows(stream(spark, [r for r in rows if r[0] % 3 == k]))
        store.apply(batch, store.last + 1)
        store.apply(batch, store.last)  # a batch that is run again counts once
        if n == 1:
            store.compact()
    assert read(store.aggregates()) == expected(rows)
    fates = {r["row_id"]: r["fate"] for r in late.route(late.stream_rows(stream(spark, rows))).where("fate <> 'on_time'").collect()}
    assert {r["row_id"]: r["fate"] for r in store.corrections().collect()} == fates


@pytest.mark.parametrize("n", [0, 150])
def test_a_replay_equals_the_batch(spark, n):
    rows = random_rows(n, 7)
    assert read(late_state.replay(late.stream_rows(stream(spark, rows)), 4).aggregates()) == expected(rows)


def test_a_drained_stream_equals_the_batch(spark, tmp_path):
    rows = random_rows(150, 3)
    for k in range(3):
        stream(spark, rows[k::3]).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    store = MultisetStore(spark, str(tmp_path / "state"))
    store.run(source, str(tmp_path / "checkpoint"))
    assert store.last >= 1
    assert read(store.aggregates()) == expected(rows)


def test_revisions_grow_to_the_final_state(spark):
    rows = random_rows(200, 4)
    adjusted = late.adjustments(late.stream_rows(stream(spark, rows)))
    grown = late.aggregates(late.revisions(late.multiset(adjusted, "revision"), 3), "period", "revision")
    last = {r["period"]: r["n_rows"] for r in grown.where("revision = 3").collect()}
    assert last == {day: v[0] for day, v in expected(rows).items()}
