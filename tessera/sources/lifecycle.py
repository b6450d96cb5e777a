"""The lifecycle of releases, as whole versions of one small control document.

Every step reads the current version, checks what must hold, and commits the next one; of two that
start from one version the second fails (``StaleVersion``) and changes nothing. A step that finds its
effect in place changes nothing either, so all of them may be repeated.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.contracts import SOURCES
from tessera.sources.control import ControlTable

# The release before all others, and the states of a release.
BOOTSTRAP = "__bootstrap__"
RUNNING, SUCCEEDED, ACTIVE, INACTIVE, FAILED = "running", "succeeded", "active", "inactive", "failed"
MAX_DEPTH = 400
_BLOCKING = ("block_promotion", "quarantine_and_block")


class ReleaseConflict(ValueError):
    """A step that the state of the releases does not allow."""


def _require(holds: bool, why: str) -> None:
    if not holds:
        raise ReleaseConflict(why)


class ReleaseStore:
    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], str]):
        """``clock`` gives the moment of a step as text, so that a replay can give the same."""
        self.spark, self.clock, self._table = spark, clock, ControlTable(spark, path, "state string")

    def state(self) -> dict:
        rows = self._table.rows()
        return rows[0] if rows else {"registry": {}, "files": {}, "pointer": None}

    def _change(self, step: Callable[[dict], None]) -> dict:
        version = self._table.version()
        before = self.state()
        after = copy.deepcopy(before)
        step(after)
        if after != before:
            self._table.commit([after], version)
        return after

    # before publication ------------------------------------------------------------------------

    def begin(self, release_id: str, year: int) -> dict:
        """Open a release on top of what is active; a failed one of the same year is opened again, empty."""

        def step(state):
            if state["pointer"] is None:
                state["registry"][BOOTSTRAP] = {"status": ACTIVE, "year": None, "baseline": None}
                state["pointer"] = {"release_id": BOOTSTRAP, "prior": None, "promoted_at": self.clock()}
            row = state["registry"].get(release_id)
            _require(row is None or row["year"] == year, "the release has another year")
            if row is None or row["status"] == FAILED:
                state["files"].pop(release_id, None)
                state["registry"][release_id] = {"status": RUNNING, "year": year, "baseline": state["pointer"]["release_id"], "created_at": self.clock()}

        return self._change(step)

    def record(self, release_id: str, manifest: dict, files: Iterable[dict]) -> dict:
        """Map the files of a completed run; after completion only what is mapped already is accepted."""

        def step(state):
            row = state["registry"].get(release_id)
            _require(row is not None and row["status"] != FAILED, "no such open release")
            _require(manifest.get("status") == "completed" and bool(manifest.get("completed_at") and manifest.get("verified_at")), "the run is not completed")
            _require(manifest["source"] in SOURCES and manifest["year"] == row["year"], "source or year differ from the release's")
            made = {"table_name": manifest["source"], "source_run_id": manifest["run_id"], "ingested_at": manifest["completed_at"], "verified_at": manifest["verified_at"], "status": "selected"}
            mapped = state["files"].setdefault(release_id, {})
            for file in files:
                _require(file["row_count"] > 0, "an empty file")
                new, old = made | file, mapped.get(file["file_uri"])
                _require(old in (None, new), "the file is mapped otherwise")
                _require(old is not None or row["status"] == RUNNING, "the release takes no more files")
                mapped[file["file_uri"]] = new

        return self._change(step)

    def complete(self, release_id: str) -> dict:
        def step(state):
            row = state["registry"].get(release_id)
            _require(row is not None and row["status"] != FAILED, "no such open release")
            runs: dict[str, set] = {}
            for file in state["files"].get(release_id, {}).values():
                runs.setdefault(file["table_name"], set()).add(file["source_run_id"])
            _require(set(runs) == set(SOURCES), "a release has all sources")
            _require(all(len(r) == 1 for r in runs.values()), "a source has one run")
            if row["status"] == RUNNING:
                row |= {"status": SUCCEEDED, "completed_at": self.clock()}

        return self._change(step)

    def fail(self, release_id: str) -> dict:
        def step(state):
            row = state["registry"].get(release_id)
            _require(row is not None and row["status"] in (RUNNING, SUCCEEDED, FAILED), "a published release cannot fail")
            if row["status"] != FAILED:
                row |= {"status": FAILED, "completed_at": self.clock()}

        return self._change(step)

    # publication -------------------------------------------------------------------------------

    @staticmethod
    def _active(state: dict) -> tuple[str, dict]:
        _require(state["pointer"] is not None, "nothing is active")
        current = state["pointer"]["release_id"]
        active = [i for i, r in state["registry"].items() if r["status"] == ACTIVE]
        _require(active == [current], "pointer and registry differ")
        baseline = state["registry"][current]["baseline"]
        _require(state["pointer"]["prior"] == (None if baseline == BOOTSTRAP else baseline), "the pointer's prior release is not the baseline")
        return current, state["registry"][current]

    def _point(self, state: dict, current: str, target: str) -> None:
        state["registry"][current]["status"] = INACTIVE
        state["registry"][target] |= {"status": ACTIVE, "promoted_at": self.clock()}
        baseline = state["registry"][target]["baseline"]
        state["pointer"] = {"release_id": target, "prior": None if baseline == BOOTSTRAP else baseline, "promoted_at": self.clock()}

    def promote(self, release_id: str, results: Iterable[dict], rules: Iterable[str]) -> dict:
        """Make a candidate active whose results are those of all rules, none critical or blocking."""
        results, rules = list(results), list(rules)

        def step(state):
            current, row = self._active(state)
            if current == release_id:
                return
            candidate = state["registry"].get(release_id)
            _require(candidate is not None and candidate["status"] == SUCCEEDED, "no such candidate")
            _require(candidate["baseline"] == current, "the candidate was built on another release")
            _require(row["year"] is None or candidate["year"] >= row["year"], "the candidate is of an earlier year")
            _require(sorted(r["rule_id"] for r in results) == sorted(rules), "the results are not those of all rules")
            _require(all(r["severity"] != "critical" and r["action"] not in _BLOCKING for r in results), "a rule blocks")
            self._point(state, current, release_id)

        return self._change(step)

    def lineage(self, state: dict) -> list[str]:
        """The active release and its baselines up to the bootstrap, checked."""
        current, _ = self._active(state)
        chain, at = [], current
        while at != BOOTSTRAP:
            _require(at not in chain, "the ancestry has a cycle")
            _require(at in state["registry"], "the ancestry ends in nothing")
            _require(len(chain) <= MAX_DEPTH, "the ancestry is too long")
            chain.append(at)
            at = state["registry"][at]["baseline"]
        rows = [state["registry"][i] for i in chain]
        _require(all(r["status"] == (ACTIVE if k == 0 else INACTIVE) for k, r in enumerate(rows)), "a state in the ancestry is wrong")
        _require(all(a["year"] >= b["year"] for a, b in zip(rows, rows[1:], strict=False)), "the years of the ancestry fall")
        return chain

    def rollback(self, year: int) -> dict:
        """Point back to the nearest release of a year in the active ancestry."""

        def step(state):
            current, row = self._active(state)
            _require(current != BOOTSTRAP and year <= row["year"], "nothing to roll back to")
            target = next((i for i in self.lineage(state) if state["registry"][i]["year"] == year), None)
            _require(target is not None, "the year is not in the ancestry")
            if target != current:
                self._point(state, current, target)

        return self._change(step)

    def cleanup(self, expired: Iterable[str]) -> dict:
        """Remove releases (see ``lineage.expired``), files first; one that is or was active stays."""
        expired = set(expired)

        def step(state):
            kept = set(self.lineage(state)) | {BOOTSTRAP, state["pointer"]["prior"]}
            for release_id in expired - kept:
                if state["registry"].get(release_id, {}).get("status") in (FAILED, SUCCEEDED):
                    state["files"].pop(release_id, None)
                    state["registry"].pop(release_id)

        return self._change(step)

    # tables ------------------------------------------------------------------------------------

    def registry(self) -> DataFrame:
        rows = [(i, r["status"], r["year"], r["baseline"], r.get("created_at"), r.get("completed_at"), r.get("promoted_at")) for i, r in self.state()["registry"].items() if i != BOOTSTRAP]
        return self.spark.createDataFrame(rows, "release_id string, status string, reference_year long, baseline_release_id string, created_at string, completed_at string, promoted_at string")

    def pointer(self) -> DataFrame:
        at = self.state()["pointer"]
        return self.spark.createDataFrame([(at["release_id"], at["prior"], at["promoted_at"])] if at else [], "release_id string, prior_release_id string, promoted_at string")

    def files(self) -> DataFrame:
        rows = [(i, f["table_name"], f["file_uri"], f["source_run_id"], f["row_count"], f["status"], f["ingested_at"], f["verified_at"]) for i, files in self.state()["files"].items() for f in files.values()]
        return self.spark.createDataFrame(rows, "release_id string, table_name string, file_uri string, source_run_id string, row_count long, status string, ingested_at string, verified_at string")
