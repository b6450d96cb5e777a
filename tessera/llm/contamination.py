"""Evaluation passages inside training text, by suffix arrays of the training words.

The corpus is cut into shards of a bounded number of words, wherever its rows lie. A shard's words
are numbered by the vocabulary of the test items (0: not in it), its suffixes are sorted (prefix
doubling), and every suffix of every test item is looked up by binary search. What is found is
extended to the longest verbatim match. No row of the corpus is shuffled; only matches are.

Words are runs of letters and digits; case, accents and invisible (format) characters do not count.

Defined cases
* null and empty texts, and items of fewer than ``min_words`` words, match nothing;
* a text longer than a shard is cut with an overlap of the longest item, so that no match is lost;
* equal items, equal documents and repeated matches each give their rows, one per document and item;
* empty tables give an empty result; further columns of the inputs are ignored;
* the test items are read in blocks of a bounded number of words (52 bytes a word in every task), one
  pass over the corpus each.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut

MIN_WORDS = 13
#: Words sorted at once by one task.
SHARD_WORDS = 400_000
#: Words of test items that are looked up in one pass.
BLOCK_WORDS = 500_000
#: Matches extended at once.
HITS_AT_ONCE = 500_000

MATCH_SCHEMA = "doc_id long, item_id long, n_words long, doc_word long, item_word long"

_PLAIN = re.compile(r"[a-z0-9]+")
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_INVISIBLE, _MARK = regex.compile(r"\p{Cf}+"), regex.compile(r"\p{M}+")


def words(text: str | None) -> list[str]:
    """The words of a text as they are compared."""
    if not text:
        return []
    if text.isascii():
        return _PLAIN.findall(text.lower())
    bare = unicodedata.normalize("NFD", unicodedata.normalize("NFD", _INVISIBLE.sub("", text)).casefold())
    return _WORD.findall(_MARK.sub("", bare))


class TestItems:
    """The numbered words of a block of items, and all their suffixes of ``min_words`` or more."""

    __test__ = False

    def __init__(self, items: list[tuple[int, list[str]]], min_words: int):
        self.min_words = min_words
        items = [(i, w) for i, w in items if len(w) >= min_words]
        self.vocabulary: dict[str, int] = {}
        for _, w in items:
            for word in w:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.longest = max((len(w) for _, w in items), default=0)
        parts, starts, owners, at = [np.zeros(1, np.int32)], [], [], 1
        for item, w in items:
            parts += [np.fromiter((self.vocabulary[x] for x in w), np.int32, len(w)), np.zeros(1, np.int32)]
            starts.append(at)
            owners.append(item)
            at += len(w) + 1
        parts.append(np.zeros(self.longest + min_words, np.int32))
        self.words, self.starts, self.owners = np.concatenate(parts), np.array(starts, np.int64), np.array(owners, np.int64)
        suffixes = [np.arange(s, s + len(w) - min_words + 1) for s, (_, w) in zip(starts, items, strict=True)]
        self.suffixes = np.concatenate(suffixes).astype(np.int64) if suffixes else np.zeros(0, np.int64)
        self.keys = prefix_keys(self.words, self.suffixes, min_words)


def prefix_keys(numbers: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` numbers from each place as bytes that sort as the numbers do."""
    if not len(at):
        return np.zeros(0, f"S{4 * width}")
    window = numbers[at[:, None] + np.arange(width)[None, :]].astype(">u4")
    return np.ascontiguousarray(window).view(f"S{4 * width}").ravel()


def suffix_array(numbers: np.ndarray, depth: int) -> np.ndarray:
    """All places of ``numbers`` in the order of their suffixes, compared to the next 0 or to ``depth``
    numbers. Ranks are doubled: each round sorts by the ranks of a place and of the place after it."""
    n = len(numbers)
    rank = np.unique(numbers, return_inverse=True)[1].astype(np.int64)
    to_zero = np.zeros(n, np.int64)
    zeros = np.flatnonzero(numbers == 0)
    nearest = np.searchsorted(zeros, np.arange(n))
    to_zero = np.where(nearest < len(zeros), zeros[np.minimum(nearest, len(zeros) - 1)] if len(zeros) else n, n) - np.arange(n)
    h = 1
    while h < depth:
        follow = np.zeros(n, np.int64)
        inside = np.flatnonzero(to_zero > h)
        follow[inside] = rank[inside + h] + 1
        distinct, rank = np.unique(rank * (n + 2) + follow, return_inverse=True)
        rank = rank.astype(np.int64)
        if len(distinct) == n:
            break
        h *= 2
    return np.argsort(rank, kind="stable")


def shard_matches(docs: np.ndarray, offsets: np.ndarray, numbers: np.ndarray, items: TestItems) -> pd.DataFrame:
    """Longest matches in one shard. ``docs`` and ``offsets`` give the document and the word in it of
    each place of ``numbers``; a 0 stands after each document."""
    k = items.min_words
    inside = numbers != 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    runs = edges.reshape(-1, 2)
    runs = runs[runs[:, 1] - runs[:, 0] >= k]  # no shorter run can hold a match
    if not len(runs):
        return pd.DataFrame()
    keep = np.concatenate([np.arange(a, b + 1) for a, b in runs])  # with the 0 that ends it
    numbers = np.concatenate([[0], numbers[keep], np.zeros(items.longest + k, np.int32)])
    docs, offsets = np.concatenate([[-1], docs[keep]]), np.concatenate([[0], offsets[keep]])
    ordered = suffix_array(numbers, items.longest)
    lengths = np.zeros(len(numbers), np.int64)
    at = 1
    for a, b in runs:
        lengths[at : at + b - a] = np.arange(b - a, 0, -1)
        at += b - a + 1
    ordered = ordered[lengths[ordered] >= k]
    keys = prefix_keys(numbers, ordered, k)
    low, high = np.searchsorted(keys, items.keys, "left"), np.searchsorted(keys, items.keys, "right")
    hit = np.flatnonzero(high > low)
    out, position = [], 0
    counts = (high - low)[hit]
    while position < len(hit):
        upto = position + max(1, int(np.searchsorted(np.cumsum(counts[position:]), HITS_AT_ONCE, "right")))
        some, n = hit[position:upto], counts[position:upto]
        position = upto
        first = np.repeat(low[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        t, q = ordered[first + np.arange(n.sum())], np.repeat(items.suffixes[some], n)
        fresh = (numbers[t - 1] == 0) | (numbers[t - 1] != items.words[q - 1])  # else an earlier suffix holds it
        t, q = t[fresh], q[fresh]
        length, growing = np.full(len(t), k), np.arange(len(t))
        while len(growing):
            a, b = numbers[t[growing] + length[growing]], items.words[q[growing] + length[growing]]
            growing = growing[(a == b) & (a != 0)]
            length[growing] += 1
        item = np.searchsorted(items.starts, q, "right") - 1
        found = pd.DataFrame({"doc_id": docs[t], "item_id": items.owners[item], "n_words": length, "doc_word": offsets[t], "item_word": q - items.starts[item]})
        out.append(found.sort_values("n_words", ascending=False, kind="stable").drop_duplicates(["doc_id", "item_id"]))
    return pd.concat(out) if out else pd.DataFrame()


def _search(batches: Iterator[pd.DataFrame], items: TestItems) -> Iterator[pd.DataFrame]:
    number, overlap = items.vocabulary.get, max(items.longest - 1, 1)
    docs, offsets, parts, size = [], [], [], 0

    def shard():
        found = shard_matches(np.concatenate(docs), np.concatenate(offsets), np.concatenate(parts), items)
        docs.clear(), offsets.clear(), parts.clear()
        return found

    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_numpy(), batch["text"], strict=True):
            tokens = words(text)
            if len(tokens) < items.min_words:
                continue
            numbers = np.fromiter((number(w, 0) for w in tokens), np.int32, len(tokens))
            for at in range(0, max(1, len(numbers) - overlap), SHARD_WORDS):
                piece = numbers[at : at + SHARD_WORDS + overlap]
                parts.append(np.append(piece, np.int32(0)))
                docs.append(np.full(len(piece) + 1, doc, np.int64))
                offsets.append(np.arange(at, at + len(piece) + 1, dtype=np.int64))
                size += len(piece) + 1
                if size >= SHARD_WORDS:
                    size = 0
                    if len(found := shard()):
                        yield found
    if parts and len(found := shard()):
        yield found


def item_blocks(items: DataFrame, min_words: int, block_words: int) -> Iterator[TestItems]:
    block, size = [], 0
    for item, text in items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text").toLocalIterator():
        tokens = words(text)
        block.append((item, tokens))
        size += len(tokens)
        if size >= block_words:
            yield TestItems(block, min_words)
            block, size = [], 0
    yield TestItems(block, min_words)


def matches(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item that share ``min_words`` words or more in a row: the length of
    the longest match and where it begins in either."""
    spark, result = documents.sparkSession, None
    corpus = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    blocks = item_blocks(items, min_words, block_words)
    block, following = next(blocks), next(blocks, None)
    several = following is not None
    while block is not None:
        shared = spark.sparkContext.broadcast(block)
        part = corpus.mapInPandas(lambda batches, shared=shared: _search(batches, shared.value), MATCH_SCHEMA)
        if several:  # one block at a time in memory: its matches are written before the next is read
            part = cut(part, "matches")
            shared.unpersist()
        result = part if result is None else result.unionByName(part)
        block, following = following, next(blocks, None) if following is not None else None
    longest = F.max(F.struct("n_words", (-F.col("doc_word")).alias("d"), (-F.col("item_word")).alias("i"))).alias("m")
    return result.groupBy("doc_id", "item_id").agg(longest).select(
        "doc_id", "item_id", "m.n_words", (-F.col("m.d")).alias("doc_word"), (-F.col("m.i")).alias("item_word")
    )


def clean(documents: DataFrame, matched: DataFrame) -> DataFrame:
    """The documents without any match."""
    # nothing bounds the number of documents concerned, so they are shuffled, whatever the planner guesses
    return documents.join(matched.select("doc_id").distinct().hint("merge"), "doc_id", "left_anti")
