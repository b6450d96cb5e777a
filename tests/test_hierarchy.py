import random

import pytest

from tessera.operators import hierarchy as h
from tessera.operators import lineage

SCHEMA = "release_id string, baseline_release_id string, node string, root string, up string"


def rows(spark, links):
    return spark.createDataFrame([(a, b, "x", "y", "z") for a, b in links], SCHEMA)


def brute(links):
    parent = {}
    for a, b in links:
        if a is not None:
            parent[a] = max(parent.get(a, ""), (b or "").strip())
    parent = {a: b if b in parent and b != "__bootstrap__" else None for a, b in parent.items()}
    out = {}
    for a in parent:
        path, at = [], a
        while at is not None and at not in path:
            path.append(at)
            at = parent[at]
        out[a] = (path[-1], len(path) - 1, path[::-1]) if at is None else (min(path[path.index(at):]), -1, None)
    return out


def check(spark, links):
    want = brute(links)
    tree = h.hierarchy(rows(spark, links), "release_id", "baseline_release_id").collect()
    assert {r["node"]: (r["root"], r["depth"], r["path"]) for r in tree} == want
    below = {a: sum(a in (p[2] or []) for p in want.values()) for a in want}
    ranges = [r for r in tree if r["depth"] >= 0]
    assert all(r["size"] == below[r["node"]] == r["high"] - r["low"] for r in ranges)
    for r in ranges:
        inside = {x["node"] for x in ranges if x["root"] == r["root"] and r["low"] <= x["low"] < r["high"]}
        assert inside == {x for x, p in want.items() if r["node"] in (p[2] or [])}


def test_marks_spaces_orphans_and_cycles(spark):
    check(spark, [
        ("a", None), ("b", " a"), ("b", "a "), ("c", "b"), ("d", "gone"), ("e", "__bootstrap__"), ("f", ""), ("g", "h"), ("h", "i"), ("i", "g"), ("j", "g"),
        ("k", "j"), ("s", "s"), ("t", "s"), (None, "a"), ("u", "c"), ("v", "c"),
    ])


@pytest.mark.parametrize("seed", range(2))
def test_random_graphs(spark, seed):
    random.seed(seed)
    names = [f"n{i:02d}" for i in range(60)]
    check(spark, [(n, random.choice([*names, None, None, None])) for n in names])


def test_long_chain_and_wide_star(spark):
    chain = [(f"c{i:04d}", f"c{i - 1:04d}" if i else None) for i in range(300)]
    star = [(f"s{i:04d}", "c0000") for i in range(500)]
    tree = h.hierarchy(rows(spark, chain + star), "release_id", "baseline_release_id", with_path=False)
    got = {r["node"]: (r["depth"], r["size"]) for r in tree.collect()}
    assert got["c0299"] == (299, 1) and got["c0000"] == (0, 800) and got["s0007"] == (1, 1)
    assert h.descendants(tree).count() == 300 * 299 // 2 + 500


def test_sibling_blocks_cover_their_parent_without_overlap(spark):
    sized = spark.createDataFrame([(f"n{i}", "p", i % 3) for i in range(50)], "node string, parent string, below long")
    got = {r["node"]: r["offset"] for r in h.sibling_offsets(sized, block=7).collect()}
    spans = sorted((got[f"n{i}"], got[f"n{i}"] + 1 + i % 3) for i in range(50))
    assert spans[0][0] == 1 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_empty(spark):
    assert h.hierarchy(rows(spark, []), "release_id", "baseline_release_id").count() == 0


def test_chain_of_one_release(spark):
    registry = spark.createDataFrame(
        [("a", None, 2023), ("b", "a", 2024), ("c", "b", 2024), ("d", "a", 2024), ("x", "y", 2024), ("y", "x", 2023)],
        "release_id string, baseline_release_id string, reference_year long",
    )
    steps = lineage.chain(registry, "c")
    assert {tuple(r) for r in steps.select("release_id", "chain_level").collect()} == {("c", 0), ("b", 1), ("a", 2)}
    assert {(r["reference_year"], r["release_id"]) for r in lineage.nearest_per_year(steps).collect()} == {(2024, "c"), (2023, "a")}
    assert [lineage.chain(registry, x).count() for x in ("x", "none", None)] == [0, 0, 0]


def test_lineages_to_roll_back_and_to_protect(spark):
    registry = spark.createDataFrame(
        [("a", None, 2023), ("b", "a", 2024), ("c", "b ", 2025), ("d", "a", 2024), ("e", "gone", 2024), ("x", "y", 2024), ("y", "x", 2023), ("z", "x", 2023)],
        "release_id string, baseline_release_id string, reference_year long",
    )
    got = {tuple(r) for r in lineage.rollback_lineage(registry, "c").collect()}
    assert got == {("c", 2025, 0, "|c|", False), ("b", 2024, 1, "|c|b|", False), ("a", 2023, 2, "|c|b|a|", False)}
    assert lineage.rollback_lineage(registry, "c", levels=1).count() == 2
    assert [tuple(r)[::4] for r in lineage.rollback_lineage(registry, "z").collect()] == [("z", True)] and lineage.rollback_lineage(registry, "none").count() == 0
    kept = lambda *roots: {r[0] for r in lineage.protected(registry, spark.createDataFrame([(x,) for x in roots], "release_id string")).collect()}
    assert kept("c") == {"a", "b", "c"} and kept("d", "e") == {"a", "d", "e"} and kept("z") == {"x", "y", "z"} and kept("none") == set()
    chain = spark.createDataFrame([(f"c{i:04d}", f"c{i - 1:04d}" if i else None, 2024) for i in range(450)], registry.schema)
    assert lineage.rollback_lineage(chain, "c0449").count() == 401
    assert lineage.protected(chain, spark.createDataFrame([("c0449",)], "release_id string")).count() == 450
