"""Long exact spans that stand in more than one document, by fixed-block anchors.

For a least span of L characters the documents are cut into non-overlapping blocks of L/2 (rounded
down, and any span of L holds a whole one). The blocks are the index; every rolling window of that
length probes it, by a rolling hash, in one equality join.

* Pairs: documents that meet in the join are compared themselves, once for each pair: the places where
  windows of L characters agree and cannot be lengthened to the left are found, checked character by
  character and extended to maximal repeats.
* Shares: no pairs are made. A window that meets a block of another document marks the windows of L
  characters around it; of these the ones that stand in two documents are found by one aggregation on
  their 128-bit hash, and the characters they cover are counted.

Equal texts are one class and are compared once; the classes are opened at the end. A document lists
each different window once, so a text that repeats itself does not multiply its hits. Both sides of
every join on hashes or texts are shuffled, never broadcast: nothing here says how large they are. The
windows are not sorted, they meet a hash table of their partition's blocks (1/50 of the rows).

Defined cases
* characters are code points; nothing is normalised; null, empty and shorter texts share nothing;
* documents of equal text share all of it; a span repeated within one document only is not shared;
* a text of any length is hashed in blocks that overlap by a window, with the same result;
* document ids are unique; an empty table gives an empty result; further columns are ignored;
* lengths of repeats beyond L are found by comparing hashes of 64 bits, the first L characters
  themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut

MIN_CHARS = 100
#: Characters hashed at once.
HASH_BLOCK = 1_000_000
#: Beginnings of repeats extended at once.
HITS_AT_ONCE = 50_000

PAIR_SCHEMA = "doc_id_a long, doc_id_b long, n_spans long, n_chars long, start_a long, start_b long"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2^64. The base is odd, so it has an inverse, and the hash of any
    stretch comes from two prefix sums."""

    def __init__(self, base: int, salt: int):
        self.base, self.inverse, self.salt = base, pow(base, -1, 1 << 64), np.uint64(salt)
        self.up = self.down = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.up):
            powers = lambda b: np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(2 * n, b, np.uint64)]), dtype=np.uint64)
            self.up, self.down = powers(self.base), powers(self.inverse)

    def sums(self, points: np.ndarray) -> np.ndarray:
        self._reach(len(points) + 1)
        mixed = _mix(points.astype(np.uint64) + self.salt)
        return np.concatenate([[np.uint64(0)], np.cumsum(mixed * self.up[: len(mixed)], dtype=np.uint64)])

    def windows(self, points: np.ndarray, width: int) -> np.ndarray:
        """The hash of every window of ``width`` code points."""
        out = []
        for at in range(0, max(0, len(points) - width + 1), HASH_BLOCK):
            sums = self.sums(points[at : at + HASH_BLOCK + width - 1])
            n = len(sums) - width
            out.append(_mix((sums[width:] - sums[:n]) * self.down[:n]))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def blocks(self, points: np.ndarray, width: int) -> np.ndarray:
        """The hashes of the whole non-overlapping blocks alone."""
        n = len(points) // width
        self._reach(width)
        mixed = _mix(points[: n * width].astype(np.uint64) + self.salt).reshape(n, width)
        return _mix((mixed * self.up[:width]).sum(axis=1, dtype=np.uint64))


FIRST, SECOND = Rolling(0x9E3779B97F4A7C15, 1), Rolling(0xD1342543DE82EF95, 0x5851F42D4C957F2D)


def _emit(batches: Iterator[pd.DataFrame], least: int, blocks: bool) -> Iterator[pd.DataFrame]:
    hashed = FIRST.blocks if blocks else FIRST.windows
    hashes, docs, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_numpy(), batch["text"], strict=True):
            found = np.unique(hashed(code_points(text), least // 2))
            hashes.append(found.view(np.int64))
            docs.append(np.full(len(found), doc, np.int64))
            size += len(found)
            if size >= HASH_BLOCK:
                yield pd.DataFrame({"h": np.concatenate(hashes), "doc_id": np.concatenate(docs)})
                hashes, docs, size = [], [], 0
    if size:
        yield pd.DataFrame({"h": np.concatenate(hashes), "doc_id": np.concatenate(docs)})


def _beginnings(a: np.ndarray, b: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) where windows of ``least`` agree and the characters before them do not, so that no
    other place of the same repeat is looked at, however often a text repeats itself."""
    known, place = np.unique(FIRST.windows(b, least), return_inverse=True)
    hashes = FIRST.windows(a, least)
    at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    i = np.flatnonzero(known[at] == hashes) if len(known) else np.zeros(0, np.int64)
    if not len(i):
        return
    room = np.int64(1 << 22)  # more than there are code points
    before = lambda points, none: np.concatenate([[none], points[:-1].astype(np.int64) + 2])
    key = place.astype(np.int64) * room + before(b, 0)[: len(place)]
    order = np.argsort(key, kind="stable")
    ranked, base = key[order], at[i].astype(np.int64) * room
    own = base + before(a, 1)[i]
    sides = (
        (np.searchsorted(ranked, base, "left"), np.searchsorted(ranked, own, "left")),
        (np.searchsorted(ranked, own, "right"), np.searchsorted(ranked, base + room, "left")),
    )
    low, high = (np.concatenate([s[k] for s in sides]) for k in (0, 1))
    i, n = np.concatenate([i, i])[high > low], (high - low)[high > low]
    low = low[high > low]
    upto = np.cumsum(n)
    for first in range(0, int(upto[-1]) if len(upto) else 0, HITS_AT_ONCE):
        number = np.arange(first, min(first + HITS_AT_ONCE, int(upto[-1])))
        run = np.searchsorted(upto, number, "right")
        yield i[run], order[low[run] + number - (upto[run] - n[run])]


def maximal_repeats(a: np.ndarray, b: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All maximal repeats (starts in a, starts in b, lengths) of ``least`` or more between two texts,
    some at a time."""
    sums_a = sums_b = None
    for i, j in _beginnings(a, b, least):
        same = (a[i[:, None] + np.arange(least)] == b[j[:, None] + np.arange(least)]).all(axis=1)
        i, j = i[same], j[same]
        if sums_a is None:
            sums_a, sums_b = FIRST.sums(a), FIRST.sums(b)
        low, high = np.full(len(i), least), np.minimum(len(a) - i, len(b) - j)
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = (sums_a[i + middle] - sums_a[i]) * FIRST.down[i] == (sums_b[j + middle] - sums_b[j]) * FIRST.down[j]
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        yield i, j, low


def _compare(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_a, text_a, doc_b, text_b in zip(batch["doc_id_a"], batch["text_a"], batch["doc_id_b"], batch["text_b"], strict=True):
            n, best = 0, None
            for i, j, length in maximal_repeats(code_points(text_a), code_points(text_b), least):
                n += len(length)
                if len(length) and (best is None or length.max() > best[0]):
                    k = int(length.argmax())
                    best = (int(length[k]), int(i[k]), int(j[k]))
            if best:
                rows.append((doc_a, doc_b, n, *best))
        if rows:
            yield pd.DataFrame(rows, columns=["doc_id_a", "doc_id_b", "n_spans", "n_chars", "start_a", "start_b"])


def _around(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Of texts with the hashes of their windows that met a block elsewhere: every window of ``least``
    that holds such a window, with its place and two hashes."""
    width = least // 2
    for batch in batches:
        for doc, text, hits in zip(batch["doc_id"].to_numpy(), batch["text"], batch["hits"], strict=True):
            points = code_points(text)
            met = np.flatnonzero(np.isin(FIRST.windows(points, width).view(np.int64), np.asarray(hits, np.int64)))
            n = len(points) - least + 1
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, np.clip(met - (least - width), 0, n), 1)
            np.add.at(edge, np.clip(met + 1, 0, n), -1)
            starts = np.flatnonzero(np.cumsum(edge[:n]) > 0)
            for at in range(0, len(starts), HASH_BLOCK):
                some = starts[at : at + HASH_BLOCK]
                stretch = points[some[0] : some[-1] + least]
                yield pd.DataFrame({
                    "h1": FIRST.windows(stretch, least)[some - some[0]].view(np.int64), "h2": SECOND.windows(stretch, least)[some - some[0]].view(np.int64),
                    "doc_id": np.full(len(some), doc, np.int64), "start": some,
                })


def text_classes(documents: DataFrame, least: int) -> DataFrame:
    """(doc_id, class_id, n_members): documents long enough, with the smallest id of equal texts."""
    keyed = documents.where(F.col("doc_id").isNotNull() & (F.length("text") >= least)).select(
        "doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("2"), "text").alias("k2"), F.length("text").alias("k3")
    )
    classes = keyed.groupBy("k1", "k2", "k3").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_members"))
    return keyed.join(classes, ["k1", "k2", "k3"]).select("doc_id", "class_id", "n_members")


class SharedSpans:
    """The classes of equal texts of a corpus and one text of each, both written once."""

    def __init__(self, documents: DataFrame, least: int = MIN_CHARS):
        if least < 2:
            raise ValueError("a block needs a character")
        self.documents, self.least = documents, least
        self.classes = cut(text_classes(documents, least), "classes")
        heads = self.classes.where(F.col("doc_id") == F.col("class_id")).select("doc_id")
        self.texts = cut(documents.select("doc_id", "text").join(heads, "doc_id", "left_semi"), "heads")

    def _hashes(self, blocks: bool) -> DataFrame:
        least = self.least
        return self.texts.mapInPandas(lambda x: _emit(x, least, blocks), "h long, doc_id long")

    def candidates(self) -> DataFrame:
        """Pairs of classes that meet: a block of one and a window of the other agree."""
        blocks, windows = self._hashes(True).withColumnRenamed("doc_id", "x"), self._hashes(False).withColumnRenamed("doc_id", "y")
        met = windows.join(blocks.hint("shuffle_hash"), "h").where(F.col("x") != F.col("y"))
        return met.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).distinct()

    def spans(self) -> DataFrame:
        """Pairs of classes that share a span: number of maximal repeats, length and places of the longest."""
        least = self.least
        first = self.texts.select(F.col("doc_id").alias("doc_id_a"), F.col("text").alias("text_a")).hint("merge")
        second = self.texts.select(F.col("doc_id").alias("doc_id_b"), F.col("text").alias("text_b")).hint("merge")
        pairs = self.candidates().join(first, "doc_id_a").join(second, "doc_id_b")
        return pairs.select("doc_id_a", "text_a", "doc_id_b", "text_b").mapInPandas(lambda x: _compare(x, least), PAIR_SCHEMA)

    def pairs(self) -> DataFrame:
        """All pairs of documents that share a span, classes opened."""
        between = cut(self.spans(), "spans").select("doc_id_a", "doc_id_b")
        left = self.classes.select(F.col("class_id").alias("doc_id_a"), F.col("doc_id").alias("a"))
        right = self.classes.select(F.col("class_id").alias("doc_id_b"), F.col("doc_id").alias("b"))
        opened = between.join(left, "doc_id_a").join(right, "doc_id_b").select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b"))
        copied = self.classes.where("n_members > 1")
        equal = copied.select("class_id", F.col("doc_id").alias("doc_id_a")).join(
            copied.select("class_id", F.col("doc_id").alias("doc_id_b")), "class_id"
        ).where(F.col("doc_id_a") < F.col("doc_id_b")).select("doc_id_a", "doc_id_b")
        return opened.unionByName(equal)

    def covered(self) -> DataFrame:
        """(class_id, covered): how many characters of a class stand in a span that another has too."""
        least = self.least
        index = self._hashes(True).groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        met = self._hashes(False).join(index.hint("shuffle_hash"), "h").where((F.col("lo") != F.col("doc_id")) | (F.col("hi") != F.col("doc_id")))
        hits = met.groupBy("doc_id").agg(F.collect_list("h").alias("hits"))  # at most one for each character of one text
        marked = hits.hint("merge").join(self.texts, "doc_id").select("doc_id", "text", "hits")
        around = cut(marked.mapInPandas(lambda x: _around(x, least), "h1 long, h2 long, doc_id long, start long"), "windows")
        common = around.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h1", "h2")
        inside = around.hint("merge").join(common, ["h1", "h2"]).select("doc_id", "start")
        following = F.lead("start").over(Window.partitionBy("doc_id").orderBy("start"))
        fresh = F.least(F.lit(least), F.coalesce(following - F.col("start"), F.lit(least)))
        return inside.withColumn("fresh", fresh).groupBy(F.col("doc_id").alias("class_id")).agg(F.sum("fresh").alias("covered"))

    def shares(self) -> DataFrame:
        """Per document its characters and how many of them stand in a span that another document has
        too. Documents with copies share all, those below the least length nothing. Without any
        character (null or empty) there is no share; a null text is a class of its own."""
        lengths = self.documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.length("text").cast("long").alias("n_chars"))
        long = self.classes.join(self.covered(), "class_id", "left").join(lengths, "doc_id").select(
            "doc_id", "class_id", "n_chars",
            F.when(F.col("n_members") > 1, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0))).cast("long").alias("shared_chars"),
        )
        short = self.documents.where(F.coalesce(F.length("text") < self.least, F.lit(True))).select("doc_id", "text")
        few = lengths.where(F.coalesce(F.col("n_chars") < self.least, F.lit(True))).join(text_classes(short, 0), "doc_id", "left").select(
            "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "n_chars", F.lit(0).cast("long").alias("shared_chars")
        )
        share = F.when(F.col("n_chars") > 0, F.round(F.col("shared_chars") / F.col("n_chars"), 6))
        return long.unionByName(few).withColumn("shared_share", share)
