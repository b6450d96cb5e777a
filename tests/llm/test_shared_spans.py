import random

import numpy as np
import pytest

from tessera.llm import shared_spans as s

SCHEMA = "doc_id long, text string, h long, class_id long"


def spans(spark, docs, least):
    return s.SharedSpans(spark.createDataFrame([(i, t, None, None) for i, t in docs], SCHEMA), least)


def brute_pairs(docs, k):
    grams = {i: {t[p : p + k] for p in range(len(t) - k + 1)} for i, t in docs if t}
    return {(a, b) for a in grams for b in grams if a < b and grams[a] & grams[b]}


def brute_shares(docs, k):
    out = {}
    for i, t in docs:
        if t is None:
            out[i] = (None, 0)
            continue
        others = {u[p : p + k] for j, u in docs if j != i and u for p in range(len(u) - k + 1)}
        covered = set()
        for p in range(len(t) - k + 1):
            if t[p : p + k] in others:
                covered |= set(range(p, p + k))
        out[i] = (len(t), len(covered))
    return out


def check(spark, docs, least):
    found = spans(spark, docs, least)
    pairs = [tuple(r) for r in found.pairs().select("doc_id_a", "doc_id_b").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute_pairs(docs, least)
    assert {r["doc_id"]: (r["n_chars"], r["shared_chars"]) for r in found.shares().collect()} == brute_shares(docs, least)


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, seed):
    random.seed(seed)
    text = lambda n: "".join(random.choice("abcdefgh é\U0001f600") for _ in range(n))
    shared = [text(n) for n in (19, 20, 21, 39, 60)]
    docs = [(i, text(random.randrange(0, 50)) + random.choice([*shared, ""]) + text(random.randrange(0, 50)) + random.choice([*shared, ""])) for i in range(40)]
    docs += [(100, None), (101, ""), (102, docs[0][1]), (103, docs[0][1]), (104, shared[4]), (105, shared[1]), (106, shared[0])]
    check(spark, docs, 20)


def test_texts_that_repeat_themselves(spark):
    docs = [(1, "a" * 300), (2, "x" + "a" * 30), (3, "ab" * 90), (4, "b" + "a" * 19 + "c"), (5, "ab" * 12 + "zz"), (6, "aab" * 50), (7, "q" * 100 + "aab" * 7)]
    check(spark, docs, 20)


def test_one_hundred_and_no_less(spark):
    random.seed(5)
    span = "".join(random.choice("abcdefghij") for _ in range(100))
    docs = [(1, "start " + span + " end"), (2, "other " + span), (3, span[:99] + "#" * 50), (4, span[1:] + "+" * 50), (5, span)]
    got = {tuple(r) for r in spans(spark, docs, 100).pairs().collect()}
    assert got == {(1, 2), (1, 5), (2, 5)} == brute_pairs(docs, 100)


def test_every_alignment_is_met():
    random.seed(2)
    for least in (100, 21):
        for offset in range(0, 110):
            span = np.array([random.randrange(1 << 20) for _ in range(least)], np.uint32)
            a = np.concatenate([np.arange(offset, dtype=np.uint32) + (1 << 20), span, np.arange(30, dtype=np.uint32) + (1 << 20)])
            assert np.isin(s.FIRST.blocks(a, least // 2), s.FIRST.windows(span, least // 2)).any(), offset


def brute_repeats(a, b, k):
    out = set()
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if n >= k and (i == 0 or j == 0 or a[i - 1] != b[j - 1]):
                out.add((i, j, n))
    return out


@pytest.mark.parametrize("alphabet", ["a", "ab", "abc"])
def test_all_maximal_repeats(monkeypatch, alphabet):
    monkeypatch.setattr(s, "HITS_AT_ONCE", 7)
    random.seed(11)
    for _ in range(20):
        a, b = ("".join(random.choice(alphabet) for _ in range(random.randrange(0, 60))) for _ in range(2))
        got = [t for part in s.maximal_repeats(s.code_points(a), s.code_points(b), 5) for t in zip(*(x.tolist() for x in part), strict=True)]
        assert len(got) == len(set(got)) and set(got) == brute_repeats(a, b, 5)


def test_a_page_of_one_character(spark):
    docs = [(1, "-" * 60_000), (2, "x" + "-" * 50_000), (3, "-" * 99 + "y"), (4, "=" * 500)]
    found = spans(spark, docs, 100)
    assert [tuple(r) for r in found.spans().collect()] == [(1, 2, 59_901 + 49_901 - 1, 50_000, 0, 1)]
    assert {r["doc_id"]: r["shared_chars"] for r in found.shares().collect()} == {1: 60_000, 2: 50_000, 3: 0, 4: 0}


def test_nothing_of_the_corpus_is_broadcast(spark):
    """With broadcasts allowed at any size the joins of hashes and texts are shuffled all the same."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 30))
    try:
        found = spans(spark, [(i, "text " * 30 + str(i)) for i in range(20)], 100)
        for frame in (found.candidates(), found.spans(), found.covered()):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "MapInPandas" in plan or "Window" in plan
            assert "Broadcast" not in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hash_blocks_agree(monkeypatch):
    random.seed(3)
    points = np.array([random.randrange(5) for _ in range(5000)], np.uint32)
    whole = s.FIRST.windows(points, 30)
    monkeypatch.setattr(s, "HASH_BLOCK", 333)
    assert (s.FIRST.windows(points, 30) == whole).all() and len(whole) == 4971
    windows = {tuple(points[i : i + 30]) for i in range(4971)}
    assert len(np.unique(whole)) == len(windows)


def test_empty(spark):
    assert spans(spark, [], 100).pairs().count() == 0
    assert [tuple(r) for r in spans(spark, [(1, "short"), (2, "")], 100).shares().orderBy("doc_id").collect()] == [(1, 1, 5, 0, 0.0), (2, 2, 0, 0, None)]
