import datetime as dt
import itertools

import pytest

from tessera.operators.gate import RULES
from tessera.sources import bronze, contracts
from tessera.sources.control import StaleVersion
from tessera.sources.lifecycle import BOOTSTRAP, ReleaseConflict, ReleaseStore
from tessera.sources.retry import poll
from tests.test_sources import uf_rows

GOOD = [{"rule_id": r, "severity": "pass", "action": "promote"} for r in RULES]


def manifest(source, year, run="run", **changed):
    return {"status": "completed", "source": source, "year": year, "run_id": run, "completed_at": "2025-01-01", "verified_at": "2025-01-02"} | changed


@pytest.fixture
def store(spark, tmp_path):
    ticks = itertools.count()
    return ReleaseStore(spark, str(tmp_path), lambda: f"t{next(ticks):04d}")


def publish(store, release_id, year):
    store.begin(release_id, year)
    for source in contracts.SOURCES:
        store.record(release_id, manifest(source, year), [{"file_uri": f"{release_id}/{source}", "row_count": 1}])
    store.complete(release_id)
    return store.promote(release_id, GOOD, RULES)


def test_releases_follow_each_other_and_roll_back(store):
    publish(store, "a", 2023)
    assert store.state()["pointer"]["prior"] is None
    publish(store, "b", 2024)
    publish(store, "c", 2024)
    at = store.state()["pointer"]
    assert (at["release_id"], at["prior"]) == ("c", "b") and store.lineage(store.state()) == ["c", "b", "a"]
    assert publish_again(store, "c") == store.state()  # a replay changes nothing
    back = store.rollback(2023)
    assert (back["pointer"]["release_id"], back["pointer"]["prior"], back["registry"]["c"]["status"]) == ("a", None, "inactive")
    assert store.rollback(2023) == back
    for year in (2024, 2022):
        with pytest.raises(ReleaseConflict):
            store.rollback(year)
    states = {r["release_id"]: r["status"] for r in store.registry().collect()}
    assert states == {"a": "active", "b": "inactive", "c": "inactive"} and store.pointer().first()["release_id"] == "a" and store.files().count() == 18


def publish_again(store, release_id):
    return store.promote(release_id, GOOD, RULES)


def test_what_is_not_allowed(store):
    with pytest.raises(ReleaseConflict):
        store.promote("a", GOOD, RULES)
    store.begin("a", 2024)
    assert store.begin("a", 2024)["registry"]["a"]["baseline"] == BOOTSTRAP
    for step in (
        lambda: store.begin("a", 2025), lambda: store.complete("a"), lambda: store.record("x", manifest("uf", 2024), []),
        lambda: store.record("a", manifest("uf", 2023), []), lambda: store.record("a", manifest("other", 2024), []), lambda: store.record("a", manifest("uf", 2024, status="failed"), []),
        lambda: store.record("a", manifest("uf", 2024), [{"file_uri": "f", "row_count": 0}]), lambda: store.promote("a", GOOD, RULES),
    ):
        before = store.state()
        with pytest.raises(ReleaseConflict):
            step()
        assert store.state() == before
    for source in contracts.SOURCES:
        store.record("a", manifest(source, 2024), [{"file_uri": source, "row_count": 2}])
    with pytest.raises(ReleaseConflict, match="otherwise"):
        store.record("a", manifest("uf", 2024, run="r2"), [{"file_uri": "uf", "row_count": 2}])
    store.complete("a")
    store.record("a", manifest("uf", 2024), [{"file_uri": "uf", "row_count": 2}])
    with pytest.raises(ReleaseConflict, match="no more files"):
        store.record("a", manifest("uf", 2024), [{"file_uri": "more", "row_count": 2}])
    for results in (GOOD[1:], [*GOOD[1:], GOOD[0] | {"severity": "critical"}], [*GOOD[1:], GOOD[0] | {"action": "block_promotion"}], [*GOOD, GOOD[0]]):
        with pytest.raises(ReleaseConflict):
            store.promote("a", results, RULES)
    store.begin("late", 2024)  # built on the same release
    store.promote("a", GOOD, RULES)
    with pytest.raises(ReleaseConflict, match="cannot fail"):
        store.fail("a")
    store.fail("late")
    store.fail("late")
    assert store.begin("late", 2024)["registry"]["late"]["baseline"] == "a"  # opened again on what is active now
    store.fail("late")
    assert set(store.cleanup(["late", "a", "none"])["registry"]) == {BOOTSTRAP, "a"}


def test_of_two_writers_one_wins(store, spark):
    store.begin("a", 2024)
    version = store._table.version()
    store.begin("b", 2024)
    with pytest.raises(StaleVersion):
        store._table.commit([{}], version)


def test_a_batch_is_run_once(spark, tmp_path):
    contract, store = contracts.contract("uf"), bronze.ManifestStore(spark, str(tmp_path / "manifests"))
    run = lambda rows, attempt: bronze.execute_batch(spark, rows, contract, 2024, str(tmp_path / "bronze"), store, attempt, f"2025-01-0{attempt}", 1 << 63)
    first = run(uf_rows(spark, 3), "1")
    assert first["status"] == "completed" and spark.read.parquet(first["path"]).count() == 3
    again = run(uf_rows(spark, 3), "2")
    assert (again["status"], again["verified_at"], again["run_id"]) == ("skipped", "2025-01-02", first["run_id"])
    other = run(uf_rows(spark, 4), "3")
    assert other["run_id"] != first["run_id"] and other["row_count"] == 4
    with pytest.raises(LookupError):
        bronze.select_completed(store.read(spark), [("uf", 2024)])  # two runs
    one = store.read(spark).where(f"run_id = '{first['run_id']}'")
    assert bronze.select_completed(one, [("uf", 2024)]) == {("uf", 2024): first["run_id"]}
    for wrong in ([("uf", 2025)], [("uf", 2024), ("municipio", 2024)]):
        with pytest.raises(LookupError):
            bronze.select_completed(one, wrong)


def test_polls_are_bounded():
    answers = iter([1, 2, 3])
    assert poll(lambda: next(answers), 3, 3) == 3
    with pytest.raises(TimeoutError, match="after 2"):
        poll(lambda: dt.date(2025, 1, 1), None, 2)
