import datetime as dt
import random

import pytest

from tessera.operators import copies

SCHEMA = "delivery_id long, event_id string, message_id string, event_time string, publish_time timestamp, ingestion_time timestamp, row_id string, ord string"
BASE = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def messages(spark, rows):
    return copies.message_rows(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA))


def random_rows(n, seed, keys):
    random.seed(seed)
    rows = []
    for i in range(n):
        event = BASE + dt.timedelta(minutes=random.randrange(3))
        arrived = BASE + dt.timedelta(hours=random.randrange(300))
        event_id = random.choice([None, f"E{random.randrange(keys)}"])
        rows.append((
            i, event_id if not event_id or random.random() < 0.5 else event_id.lower(), random.choice([None, f"m{random.randrange(keys)}"]),
            random.choice([event.isoformat(), event.isoformat().replace("+00:00", "Z"), None]), arrived, random.choice([None, arrived]),
        ))
    return rows


def expected(rows):
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first = {}
    for r in rows:
        keys = [("m", r[2])] if r[2] else []
        if r[1] and r[3]:
            keys.append(("e", r[1].lower(), dt.datetime.fromisoformat(r[3])))
        for k in keys:
            root[find(r[0])] = find(first.setdefault(k, r[0]))
    classes = {}
    for r in rows:
        classes.setdefault(find(r[0]), []).append((r[5] or r[4], r[0]))
    return {d for c in classes.values() for _, d in sorted(c)[1:]}


@pytest.mark.parametrize(("n", "keys"), [(120, 30), (200, 150), (60, 2)])
def test_against_union_find(spark, n, keys):
    rows = random_rows(n, n, keys)
    for batches in (1, 3):
        got = [r["row_id"] for r in copies.replay(messages(spark, rows), batches, horizon_hours=5).collect()]
        assert len(got) == len(set(got)) and set(got) == expected(rows)


def test_a_later_link_takes_a_kept_row_back(spark, tmp_path):
    at = lambda h: BASE + dt.timedelta(hours=h)
    rows = [(1, "a", "m1", BASE.isoformat(), at(1), at(1)), (2, "b", "m2", BASE.isoformat(), at(2), at(2)), (3, "b", "m1", BASE.isoformat(), at(500), at(500))]
    store = copies.MessageStore(spark, str(tmp_path), horizon_hours=1)
    ids = lambda df: {r["row_id"] for r in df.collect()}
    assert ids(store.process(messages(spark, rows[:1]), 0)) == set()
    assert ids(store.process(messages(spark, rows[1:2]), 1)) == set()
    again = copies.MessageStore(spark, str(tmp_path), horizon_hours=1)  # as after a restart
    assert ids(again.process(messages(spark, rows[2:]), 2)) == {2, 3}
    assert ids(again.process(messages(spark, rows[2:]), 2)) == {2, 3}  # the batch again
    assert ids(again.process(messages(spark, rows[2:]), 3)) == set()  # its row again


def test_long_chain_and_hot_identifier(spark):
    chain = [(i, f"e{i // 2}", f"m{(i + 1) // 2}", BASE.isoformat(), BASE + dt.timedelta(seconds=i), None) for i in range(200)]
    hot = [(1000 + i, None, "hot", None, BASE + dt.timedelta(seconds=i), None) for i in range(300)]
    got = {r["row_id"] for r in copies.replay(messages(spark, chain + hot), 1).collect()}
    assert got == set(range(1, 200)) | set(range(1001, 1300))


def test_no_identifiers_and_empty(spark):
    rows = [(i, None, None, BASE.isoformat(), BASE, None) for i in range(5)] + [(9, "e", None, None, None, None), (8, "e", None, None, None, None)]
    assert copies.replay(messages(spark, rows), 2).count() == 0
    assert copies.replay(messages(spark, []), 2).count() == 0


def test_a_stop_before_the_commit_leaves_the_last_version(spark, tmp_path, monkeypatch):
    rows = random_rows(90, 5, 20)
    rows = sorted(rows, key=lambda r: r[5] or r[4])
    parts = [rows[:30], rows[30:60], rows[60:]]
    ids = lambda df: {r["row_id"] for r in df.collect()}
    store = copies.MessageStore(spark, str(tmp_path), horizon_hours=5)
    out = ids(store.process(messages(spark, parts[0]), 0))
    with monkeypatch.context() as stopped:
        def stop(*_):
            raise KeyboardInterrupt

        stopped.setattr(store.log, "commit", stop)
        with pytest.raises(KeyboardInterrupt):
            store.process(messages(spark, parts[1]), 1)
    again = copies.MessageStore(spark, str(tmp_path), horizon_hours=5)
    assert again.last == 0 and ids(again.process(messages(spark, parts[0]), 0)) == out  # what was committed is still there
    for k in (1, 2):
        out |= ids(again.process(messages(spark, parts[k]), k))
    assert out == expected(rows)
    assert again.log.numbers() == [1, 2]
    with pytest.raises(RuntimeError):
        again.log.commit(2, {})


def test_a_batch_of_timed_messages_reads_no_archive(spark, tmp_path, monkeypatch):
    """Ten days of a feed in daily batches: the folders that are opened for a batch do not grow in number."""
    store, opened = copies.MessageStore(spark, str(tmp_path), horizon_hours=24, timed_messages=True), []
    plain = store._read
    monkeypatch.setattr(store, "_read", lambda kind, batches, schema: opened.append((kind, list(batches))) or plain(kind, batches, schema))
    drops, late = set(), None
    for day in range(10):
        at = BASE + dt.timedelta(days=day)
        rows = [(10 * day + i, None, f"m{day}-{i // 2}", at.isoformat(), at, None) for i in range(6)]
        if day == 9:  # one row of the first day once more
            rows.append((999, None, "m0-0", BASE.isoformat(), at, None))
        opened.clear()
        drops |= {r["row_id"] for r in store.process(messages(spark, rows), day).collect()}
        late = [batches for kind, batches in opened if kind == "seen"]
        assert not late if day == 0 else len(late[0]) <= 2 if day < 9 else len(late[0]) == 9
    assert drops == {10 * d + i for d in range(10) for i in (1, 3, 5)} | {999}


def test_a_message_id_with_another_event_time_is_found_in_the_archive(spark, tmp_path):
    at = lambda h: BASE + dt.timedelta(hours=h)
    store = copies.MessageStore(spark, str(tmp_path), horizon_hours=1)
    batches = [[(1, None, "m", BASE.isoformat(), at(0), None), (2, None, "n", None, at(0), None)], [(3, None, "x", at(90).isoformat(), at(90), None)],
               [(4, None, "m", at(90).isoformat(), at(91), None), (5, None, "n", at(95).isoformat(), at(95), None)], [(6, None, "n", None, at(99), None)]]
    got = [{r["row_id"] for r in store.process(messages(spark, rows), 2 * k).collect()} for k, rows in enumerate(batches)]
    assert got == [set(), set(), {4, 5}, {6}]
