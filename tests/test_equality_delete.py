import datetime as dt
import random
from decimal import Decimal

import pytest

from tessera.operators import equality_delete as ed

SCHEMA = (
    "delivery_id long, event_time string, publish_time timestamp, ano long, id_municipio string, rede string, "
    "taxa_alfabetizacao decimal(28,9), change_op string, seq string, op string, value string"
)
BASE = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def feed(spark, rows):
    return ed.change_rows(spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA))


def random_feed(n, seed):
    random.seed(seed)
    out = []
    for i in range(n):
        event = BASE + dt.timedelta(minutes=random.randrange(20))
        out.append((
            i, random.choice([event.isoformat(), event.astimezone(dt.timezone(dt.timedelta(hours=-3))).isoformat(), None]), BASE + dt.timedelta(seconds=random.randrange(3)),
            random.choice([2024, None]), random.choice(["1", "2", None]), "municipal", Decimal(i), random.choice(["insert", "U", "DELETE", "d", "upd", None, "x"]),
        ))
    return out


def expected(rows):
    last = {}
    for r in rows:
        if not r[7] or r[7][0].lower() not in "iud":
            continue
        instant = dt.datetime.fromisoformat(r[1]) if r[1] else dt.datetime.min.replace(tzinfo=dt.timezone.utc)
        key, seq = r[3:6], (instant, r[2], r[0])
        if key not in last or last[key][0] < seq:
            last[key] = (seq, r)
    return {key: r[0] for key, (_, r) in last.items() if r[7][0].lower() != "d"}


def read(df):
    return {(r["ano"], r["id_municipio"], r["rede"]): r["seq"]["seq_id"] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_against_replay(spark, seed):
    rows = random_feed(120, seed)
    assert read(ed.current_rows(feed(spark, rows + rows[:20]))) == expected(rows)


def test_files_in_any_order_and_compaction(spark, tmp_path):
    rows = random_feed(150, 9)
    table = ed.EqualityDeleteTable(spark, str(tmp_path))
    for k in (2, 0, 2):
        table.append(feed(spark, rows[k::3]), f"b{k}")
    table.compact("c")
    table = ed.EqualityDeleteTable(spark, str(tmp_path))  # as after a restart
    table.append(feed(spark, rows[0::3]), "b0")  # applied before
    assert table.version == {"live": ["c"], "applied": ["b2", "b0"]}
    table.append(feed(spark, rows[1::3]), "b1")
    assert read(table.read()) == expected(rows)


def test_empty(spark):
    assert read(ed.current_rows(feed(spark, []))) == {}
    assert ed.unknown_changes(feed(spark, random_feed(50, 1))).where("op IN ('I', 'U', 'D')").count() == 0
