import random

import numpy as np
import pytest

from tessera.llm import contamination as c

DOCS, ITEMS = "doc_id long, text string, item_id long, n_words long", "item_id long, text string, doc_id long"


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, None, None) for i, t in docs], DOCS)
    e = spark.createDataFrame([(i, t, None) for i, t in items], ITEMS)
    return {(r["doc_id"], r["item_id"]): r["n_words"] for r in c.matches(d, e, **options).collect()}


def brute(docs, items, k):
    out = {}
    for i, t in docs:
        a = c.words(t)
        for j, u in items:
            b = c.words(u)
            best = 0
            for x in range(len(a)):
                for y in range(len(b)):
                    n = 0
                    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
                        n += 1
                    best = max(best, n)
            if best >= k:
                out[i, j] = best
    return out


def test_words():
    assert c.words("Café café CAFÉ, naïve_x 3º") == ["cafe", "cafe", "cafe", "naive", "x", "3º"]
    assert c.words("in​visi­ble﻿ wo⁠rds") == ["invisible", "words"]
    assert c.words(None) == c.words("") == c.words("--- !") == []
    assert c.words("Straße STRASSE") == ["strasse", "strasse"]


def test_suffixes_are_in_order():
    random.seed(1)
    numbers = np.array([random.randrange(4) for _ in range(300)] + [0] * 20, np.int32)
    ordered = c.suffix_array(numbers, 64)

    def suffix(i):
        tail = list(numbers[i:])
        return tail[: tail.index(0)] if 0 in tail else tail

    assert sorted(ordered) == list(range(320))
    assert all(suffix(a) <= suffix(b) for a, b in zip(ordered, ordered[1:], strict=False))


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed, monkeypatch):
    random.seed(seed)
    text = lambda n: " ".join(random.choice("abécd") for _ in range(n))
    items = [(i, text(random.randrange(0, 30))) for i in range(12)] + [(50, None), (51, ""), (1, text(20))]
    docs = [(i, text(random.randrange(0, 60))) for i in range(25)] + [(90, None), (91, ""), (92, items[3][1])]
    docs += [(93, "x " + (items[4][1] or "").upper() + " y"), (94, "z " * 40)]
    monkeypatch.setattr(c, "HITS_AT_ONCE", 7)
    assert run(spark, docs, items, min_words=5) == brute(docs, items, 5)
    assert run(spark, docs, items, min_words=5, block_words=40) == brute(docs, items, 5)


def test_one_text_longer_than_a_shard(spark):
    item = " ".join(f"w{i}" for i in range(30))
    filler = [f"w{i % 29}" for i in range(0, 2 * c.SHARD_WORDS, 3)]
    place = 2 * c.SHARD_WORDS // 3 - 40
    text = " ".join([*filler[:place], item, *filler[place:]])
    assert run(spark, [(1, text), (2, text[:100])], [(7, item)]) == {(1, 7): 30}


def test_thirteen_words_are_enough_and_twelve_are_not(spark):
    item = " ".join(f"w{i}" for i in range(20))
    twelve, thirteen = " ".join(f"W{i}" for i in range(3, 15)), ", ".join(f"w{i}" for i in range(3, 16))
    assert run(spark, [(1, twelve + " end"), (2, thirteen + " end"), (3, item), (3, item)], [(9, item), (8, item)]) == {
        (2, 9): 13, (3, 9): 20, (2, 8): 13, (3, 8): 20,
    }
    assert run(spark, [], [(9, item)]) == {} and run(spark, [(1, item)], []) == {}
