"""Questions about the ancestry of a few releases. Their chains are found by doubling: with the table of
2^k-th ancestors the first 2^k releases of a chain give the next 2^k, so a chain may be as long as it is
and takes the logarithm of that in rounds; a cycle is noticed and gives no chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessera.operators.hierarchy import parent_links
from tessera.operators.relational import latest
from tessera.session import cut, drop_path, new_table_path


def ancestries(registry: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, node, level, cyclic): every registered release of ``starts`` (release_id) at level 0 and all
    its ancestors, each once. ``cyclic`` says that the ancestry of the start never ends; its levels are
    then those at which a release is met first."""
    spark = registry.sparkSession
    links = cut(parent_links(registry, "release_id", "baseline_release_id"), "links")
    n, jump, jump_path, reach = links.count(), links.where(F.col("parent").isNotNull()).select("node", F.col("parent").alias("up")), None, 1
    wanted = starts.select(F.col("release_id").alias("node")).distinct().join(links.select("node"), "node", "left_semi")
    total = cut(wanted.select(F.col("node").alias("start"), "node", F.lit(0).cast("long").alias("level")), "chains")
    while reach <= n:
        seen = Observation("chains")
        further = total.join(jump, "node").select("start", F.col("up").alias("node"), (F.col("level") + reach).alias("level"))
        further = cut(further.observe(seen, F.count_if(F.col("level") == 2 * reach - 1).alias("open")), "chains")
        total = total.unionByName(further)
        reach *= 2
        if not seen.get["open"]:
            break
        far = jump.select(F.col("node").alias("up"), F.col("up").alias("up2"))
        path = new_table_path(spark, "jumps")
        jump = cut(jump.join(far, "up").select("node", F.col("up2").alias("up")), "jumps", path)
        if jump_path:
            drop_path(spark, jump_path)
        jump_path = path
    met = total.groupBy("start", "node").agg(F.min("level").alias("level"), F.count(F.lit(1)).alias("times"))
    cyclic = met.groupBy("start").agg((F.max("times") > 1).alias("cyclic"))
    return met.join(cyclic, "start").select("start", "node", "level", "cyclic")


def _years(registry: DataFrame) -> DataFrame:
    return registry.groupBy("release_id").agg(F.max("reference_year").alias("reference_year"))


def _ancestry(registry: DataFrame, start: str | None) -> DataFrame:
    starts = registry.sparkSession.createDataFrame([(start,)] if start is not None else [], "release_id string")
    return ancestries(registry, starts).withColumnRenamed("node", "release_id")


def chain(registry: DataFrame, start: str | None) -> DataFrame:
    """(release_id, reference_year, chain_level) from ``start`` up to its root; ``start`` has level 0.
    Without a start, of one that is not registered, or of one whose ancestry runs into a cycle, there is
    no chain."""
    found = _ancestry(registry, start).where("NOT cyclic")
    return found.join(_years(registry), "release_id").select("release_id", "reference_year", F.col("level").alias("chain_level"))


def nearest_per_year(steps: DataFrame) -> DataFrame:
    """Of each reference year the release nearest to the start."""
    return latest(steps.withColumn("near_", -F.col("chain_level")), ["reference_year"], ["near_"], ["release_id", "chain_level"])


def expired(registry: DataFrame, protected: DataFrame, as_of: str, failed_days: int = 7, succeeded_days: int = 30) -> DataFrame:
    """Releases that may be cleaned up: failed or never promoted, older than their keep, and not in
    the protected lineage."""
    age = F.lit(as_of).cast("timestamp")
    old = ((F.col("status") == "failed") & (F.col("created_at") < age - F.make_dt_interval(F.lit(failed_days)))) | (
        (F.col("status") == "succeeded") & (F.col("created_at") < age - F.make_dt_interval(F.lit(succeeded_days)))
    )
    return registry.where(old).select("release_id").distinct().join(protected.select("release_id"), "release_id", "left_anti")


#: A lineage to roll back along is followed this far.
MAX_LEVELS = 400


def rollback_lineage(registry: DataFrame, start: str | None, levels: int = MAX_LEVELS) -> DataFrame:
    """(release_id, reference_year, chain_level, release_path, has_cycle) from ``start`` towards its root,
    ``levels`` steps at most, the path written |start|...|release|. If the ancestry runs into a cycle
    there is one row, for ``start``, that says so."""
    found = _ancestry(registry, start).where((F.col("level") == 0) | ((F.col("level") <= levels) & ~F.col("cyclic")))
    before = Window.partitionBy("start").orderBy("level")  # one chain of at most ``levels`` rows
    path = F.concat(F.lit("|"), F.array_join(F.collect_list("release_id").over(before), "|"), F.lit("|"))
    return found.withColumn("release_path", path).join(_years(registry), "release_id").select(
        "release_id", "reference_year", F.col("level").alias("chain_level"), "release_path", F.col("cyclic").alias("has_cycle")
    )


def protected(registry: DataFrame, roots: DataFrame) -> DataFrame:
    """The releases of ``roots`` and all their ancestors, however many there are, also around a cycle."""
    return ancestries(registry, roots).select(F.col("node").alias("release_id")).distinct()
