"""Trees of unknown depth from parent-child rows: nested-set ranges, depth, root, path, cycles.

Pointers are doubled: after round k every node knows its 2^k-th ancestor, so a tree of depth d takes
log2(d) rounds, each one shuffle join of the nodes that are still climbing.

1. Upward: subtree sizes. ``below`` counts the descendants nearer than 2^k; a round adds to each
   node what the nodes exactly 2^k below it have counted (summed before the shuffle).
2. Sibling ranges: prefix sums of the sizes over the siblings, in two levels (blocks of siblings,
   then within a block), so a parent of a third of all rows is no single task.
3. Downward: a node's preorder place is the sum of the sibling offsets on its way from the root, its
   depth the number of ranges on that way and its root the outermost of them. ``[place, place + size)``
   holds exactly its subtree.

A node whose pointer never reaches a root was not processed: it is on a cycle or runs into one.

Defined cases
* a null node is no node; repeated rows are one node (of different parents the largest is taken);
* a null or empty parent, ``root_marks`` or a parent that is not a node makes a root;
* a node that is its own parent is a cycle of one;
* nodes on or below a cycle have depth -1, as root the smallest node on the cycle, and no range,
  size or path;
* an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessera.functions.columns import trimmed
from tessera.session import cut, drop_path, new_table_path

#: Siblings in one block of the two-level prefix sum, on average.
SIBLINGS_PER_BLOCK = 50_000


class _Rounds:
    """Tables of the rounds; only the newest is kept. How many nodes are still climbing is counted while
    a table is written."""

    def __init__(self, spark, label):
        self.spark, self.label, self.last, self.climbing = spark, label, None, 0

    def write(self, df: DataFrame) -> DataFrame:
        path = new_table_path(self.spark, self.label)
        seen = Observation(self.label)
        out = cut(df.observe(seen, F.count_if(F.col("up").isNotNull()).alias("climbing")), self.label, path)
        self.climbing = seen.get["climbing"]
        if self.last:
            drop_path(self.spark, self.last)
        self.last = path
        return out


def parent_links(rows: DataFrame, node: str, parent: str, root_marks=("", "__bootstrap__")) -> DataFrame:
    """One row ``(node, parent)`` per node; the parent is null for a root."""
    plain = trimmed(F.col(parent))
    named = rows.select(F.col(node).alias("node"), F.when(~plain.isin(*root_marks), plain).alias("parent"))
    nodes = named.where(F.col("node").isNotNull()).groupBy("node").agg(F.max("parent").alias("parent"))
    known = nodes.select(F.col("node").alias("known"))
    return nodes.join(known, nodes["parent"] == known["known"], "left").select("node", F.col("known").alias("parent"))


def climb(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(settled, cyclic): the nodes that reach a root, with the number of their descendants; and those
    that were not processed, with the smallest node of their cycle."""
    rounds = _Rounds(links.sparkSession, "climb")
    # up: the 2^k-th ancestor; least: the smallest of the 2^k nodes from here
    state = rounds.write(links.select("node", "parent", F.col("parent").alias("up"), F.lit(0).cast("long").alias("below"), F.col("node").alias("least")))
    reach = 1
    while rounds.climbing:
        moving = state.where(F.col("up").isNotNull())
        gained = moving.groupBy(F.col("up").alias("to")).agg(F.sum(F.col("below") + 1).alias("gain"))
        ahead = state.select(F.col("node").alias("at"), F.col("up").alias("up2"), F.col("least").alias("least2"))
        stepped = moving.join(ahead, moving["up"] == ahead["at"]).select(
            "node", "parent", F.col("up2").alias("up"), "below", F.least("least", "least2").alias("least")
        ).unionByName(state.where(F.col("up").isNull()))
        before = rounds.climbing
        state = rounds.write(
            stepped.join(gained, stepped["node"] == gained["to"], "left").select(
                "node", "parent", "up", (F.col("below") + F.coalesce("gain", F.lit(0))).cast("long").alias("below"), "least"
            )
        )
        reach *= 2
        if rounds.climbing == before and reach > before:
            break
    settled = state.where(F.col("up").isNull()).select("node", "parent", "below")
    stuck = state.where(F.col("up").isNotNull())
    on_cycle = stuck.select(F.col("node").alias("at"), F.col("least").alias("cycle_root"))
    cyclic = stuck.join(on_cycle, stuck["up"] == on_cycle["at"], "inner").select("node", "parent", "cycle_root")
    return settled, cyclic


def sibling_offsets(sized: DataFrame, block: int = SIBLINGS_PER_BLOCK) -> DataFrame:
    """For each non-root node, 1 + the sizes of the siblings before it (by block, then by id)."""
    blocks = max(1, sized.count() // block)
    placed = sized.where(F.col("parent").isNotNull()).select(
        "node", "parent", (F.col("below") + 1).alias("size"), F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("block")
    )
    sums = placed.groupBy("parent", "block").agg(F.sum("size").alias("sum"))
    ahead = Window.partitionBy("parent").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("parent", "block", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("parent", "block").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["parent", "block"]).select(
        "node", (F.lit(1) + F.col("base") + F.col("inside")).cast("long").alias("offset")
    )


def descend(settled: DataFrame, with_path: bool = True) -> DataFrame:
    """Preorder places, depths and roots (and paths, root first) by summing along the doubled pointers:
    sibling offsets for the place, one for each step for the depth."""
    rounds = _Rounds(settled.sparkSession, "descend")
    path = F.array("node") if with_path else F.lit(None).cast("array<string>")
    state = rounds.write(
        settled.join(sibling_offsets(settled), "node", "left").select(
            "node", "parent", "below", F.col("parent").alias("up"), F.coalesce("parent", "node").alias("root"),
            F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"),
            F.coalesce("offset", F.lit(0)).cast("long").alias("place"), path.alias("path"),
        )
    )
    while rounds.climbing:
        ahead = state.select(
            F.col("node").alias("at"), F.col("up").alias("up2"), F.col("root").alias("root2"), F.col("depth").alias("depth2"),
            F.col("place").alias("place2"), F.col("path").alias("path2"),
        )
        moving, still = state.where(F.col("up").isNotNull()), state.where(F.col("up").isNull())
        state = rounds.write(
            moving.join(ahead, moving["up"] == ahead["at"]).select(
                "node", "parent", "below", F.col("up2").alias("up"), F.col("root2").alias("root"), (F.col("depth") + F.col("depth2")).alias("depth"),
                (F.col("place") + F.col("place2")).alias("place"), F.concat("path2", "path").alias("path"),
            ).unionByName(still)
        )
    return state.drop("up")


def hierarchy(rows: DataFrame, node: str, parent: str, root_marks=("", "__bootstrap__"), with_path: bool = True) -> DataFrame:
    """One row per node: parent, root, depth, size of the subtree, nested-set range [low, high) within
    its root, path from the root. Nodes of cycles: depth -1, range and path null."""
    settled, cyclic = climb(cut(parent_links(rows, node, parent, root_marks), "links"))
    placed = descend(settled, with_path)
    good = placed.select(
        "node", "parent", "root", "depth", (F.col("below") + 1).alias("size"),
        F.col("place").alias("low"), (F.col("place") + F.col("below") + 1).alias("high"), "path",
    )
    empty = {name: F.lit(None).cast(good.schema[name].dataType) for name in ("size", "low", "high", "path")}
    bad = cyclic.select(
        "node", "parent", F.col("cycle_root").alias("root"), F.lit(-1).cast("long").alias("depth"),
        *[empty[n].alias(n) for n in ("size", "low", "high", "path")],
    )
    return good.unionByName(bad)


def descendants(tree: DataFrame) -> DataFrame:
    """(ancestor, descendant) for every proper pair, from the nested-set ranges alone.

    A range is cut into dyadic blocks (at most two for each power of two); a place lies in one block
    of each power. The pairs are an equality join on (root, power, block): no comparison is made that
    finds nothing.
    """
    placed = tree.where(F.col("low").isNotNull())
    top = placed.agg(F.max("high").alias("m")).first()["m"] or 1
    powers = max(1, int(top).bit_length())
    power = F.explode(F.sequence(F.lit(0), F.lit(powers))).alias("power")
    inner = placed.where(F.col("size") > 1).select("root", F.col("node").alias("ancestor"), (F.col("low") + 1).alias("a"), F.col("high").alias("b"), power)
    # at power p the blocks still to cover are [ceil(a / 2^p), floor(b / 2^p)); those that the next power
    # does not cover are its first if odd and its last if odd
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("power"))
    first = F.call_function("div", F.col("a") + step - 1, step)
    last = F.call_function("div", F.col("b"), step)
    cover = inner.select("root", "ancestor", "power", first.alias("f"), last.alias("l")).where(F.col("f") < F.col("l"))
    left = F.when(F.col("f") % 2 == 1, F.col("f"))
    right = F.when(F.col("l") % 2 == 1, F.col("l") - 1)
    blocks = cover.select("root", "ancestor", "power", F.explode(F.array_distinct(F.array_compact(F.array(left, right)))).alias("block"))
    places = placed.where(F.col("depth") > 0).select("root", F.col("node").alias("descendant"), F.col("low"), power)
    points = places.select("root", "descendant", "power", "low").select(
        "root", "descendant", "power", F.call_function("div", F.col("low"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("power"))).alias("block")
    )
    return blocks.join(points, ["root", "power", "block"]).select("ancestor", "descendant")
