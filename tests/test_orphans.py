import datetime as dt
import random

from tessera.operators import orphans
from tessera.session import cut

PARENT = "key string, valid_from date, valid_to date, spans string, a int"
CHILD = "table_name string, release_id string, ano long, ref_key string, day date, n string, key string"
D = dt.date


def index(spark, rows):
    return orphans.parent_index(spark.createDataFrame([(*r, None, None) for r in rows], PARENT))


def refs(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], CHILD)


def test_spans_are_merged(spark):
    got = index(spark, [
        ("a", None, D(2020, 1, 1)), ("a", D(2019, 1, 1), D(2021, 1, 1)), ("a", D(2022, 1, 1), None), ("a", D(2022, 1, 1), None), ("a", D(2021, 1, 1), D(2021, 2, 1)),
        ("b", D(2022, 1, 1), D(2021, 1, 1)), (None, None, None),
    ]).collect()
    assert [(r["key"], [(str(s["a"]), str(s["b"])) for s in r["spans"]]) for r in got] == [("a", [("0001-01-01", "2021-02-01"), ("2022-01-01", "9999-12-31")])]


def test_edges_nulls_and_later_parents(spark):
    parents = index(spark, [("a", D(2025, 1, 10), D(2025, 1, 20)), ("a", D(2025, 2, 1), None), ("always", None, None)])
    days = {"before": D(2025, 1, 9), "first": D(2025, 1, 10), "last": D(2025, 1, 19), "gone": D(2025, 1, 20), "back": D(2025, 2, 1), "none": None}
    rows = [("t", name, 1, "a", day) for name, day in days.items()] + [("t", "x", 1, None, D(2025, 1, 1)), ("t", "e", 1, "", D(2025, 1, 1)), ("t", "al", 1, "always", None)]
    state = orphans.advance(None, refs(spark, rows * 2), parents)
    assert {r["release_id"] for r in orphans.found(state).collect()} == {"before", "gone", "none", "e"}
    by = {r["release_id"]: r for r in state.collect()}
    assert by["before"]["resolved_on"] == D(2025, 1, 10) and by["gone"]["resolved_on"] == D(2025, 2, 1)
    assert by["first"]["removed_on"] == D(2025, 1, 20) and by["back"]["removed_on"] is None and by["first"]["n"] == 2
    counts = {str(r["snapshot_day"]): r["open_references"] for r in orphans.snapshots(state, ["2025-01-15", "2025-01-25", "2025-02-05"]).collect()}
    assert counts == {"2025-01-15": 2, "2025-01-25": 10, "2025-02-05": 2}


def test_batches_equal_one_batch(spark):
    random.seed(4)
    day = lambda: D(2025, 1, 1) + dt.timedelta(random.randrange(60))
    parents = index(spark, [(random.choice("abc"), day(), random.choice([None, day()])) for _ in range(12)])
    rows = [("t", random.choice("rs"), random.choice([1, None]), random.choice(["a", "b", "c", "d"]), day()) for _ in range(200)]
    whole = orphans.advance(None, refs(spark, rows), parents)
    as_set = lambda df: {str(r) for r in df.drop("spans").collect()}
    for incremental in (False, True):
        parts, known = None, index(spark, [])
        for k in (1, 0, 2):
            # the parents known so far differ; the last batch sees all of them
            now = parents if k == 2 else index(spark, [("a", D(2025, 1, 5), None)] if k == 0 else [])
            parts = cut(orphans.advance(parts, refs(spark, rows[k::3]), now, orphans.changed_keys(known, now) if incremental else None), "pending")
            known = now
        assert as_set(whole) == as_set(parts)


def test_empty(spark):
    assert orphans.advance(None, refs(spark, []), index(spark, [])).count() == 0
    assert orphans.found(orphans.advance(None, refs(spark, [("t", "r", 1, "a", D(2025, 1, 1))]), index(spark, []))).count() == 1


def test_a_replay_in_batches_equals_one_batch(spark):
    """Parents arrive and go between the batches: waiting references are resolved, found ones opened again."""
    random.seed(8)
    day = lambda: D(2025, 1, 1) + dt.timedelta(random.randrange(60))
    parents = spark.createDataFrame([(random.choice("abcde"), random.choice([day(), None]), random.choice([None, day()]), None, None) for _ in range(14)], PARENT)
    rows = [("t", random.choice("rs"), random.choice([1, None]), random.choice("abcdef"), random.choice([day(), day(), None])) for _ in range(150)]
    whole = orphans.advance(None, refs(spark, rows), orphans.parent_index(parents))
    as_set = lambda df: {str(r) for r in df.drop("spans").collect()}
    for batches in (1, 2, 4):
        store = orphans.replay(refs(spark, rows), parents, batches)
        assert store.last == batches - 1 and as_set(store.state()) == as_set(whole)
        again = orphans.PendingStore(spark, store.path)  # as after a restart
        again.advance(refs(spark, rows), parents, batches - 1)
        assert as_set(again.state()) == as_set(whole)
    assert orphans.replay(refs(spark, []), parents).state().count() == 0
