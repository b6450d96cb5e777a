"""Queries for the engine's own operators, and the SQL their results are checked with."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tessera.functions.columns import instant, micros
from tessera.functions.domain import days_since, normalize_municipality_id, normalize_network, rate, year_start
from tessera.operators import fingerprint, lineage, quality, relational

QUERIES, ORACLES = {}, {}
AS_OF = "2026-01-01"
KEY = ["release_id", "ano", "id_municipio", "rede"]
LEVELS, TARGETS = quality.LEVELS, quality.TARGETS


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(spark, folder, name, domain="assessment_result"):
    """The staging projection: normalised keys, exact measures, date of the year's partition."""
    rows = table(spark, folder, name)
    measures = [c for c in rows.columns if c.startswith(("taxa", "media", "proporcao", "meta_", "percentual"))]
    place = "sigla_uf" if "sigla_uf" in rows.columns else "id_municipio"
    geography = F.upper(F.trim(place)) if place == "sigla_uf" else normalize_municipality_id(F.col(place))
    return rows.select(
        "release_id", F.col("ano").cast("long").alias("ano"), geography.alias(place), normalize_network(F.col("rede"), domain).alias("rede"),
        *[rate(F.col(m)).alias(m) for m in measures], "source_run_id", "ingested_at", year_start(F.col("ano")).alias("ano_particao"),
    )


_ID = "CASE WHEN regexp_full_match(trim(id_municipio), '[0-9]{1,7}') THEN lpad(trim(id_municipio), 7, '0') END"
_REDE = "CASE WHEN lower(trim(rede)) IN ('total', 'estadual', 'municipal', 'publica') THEN lower(trim(rede)) END"
_M = f"(SELECT release_id, ano, {_ID} AS id_municipio, {_REDE} AS rede, taxa_alfabetizacao, media_portugues, {', '.join(LEVELS)}, source_run_id, ingested_at FROM silver_municipio)"
_T = f"(SELECT release_id, ano, {_ID} AS id_municipio, {_REDE} AS rede, taxa_alfabetizacao, {', '.join(TARGETS)}, percentual_participacao, source_run_id, ingested_at FROM silver_meta_alfabetizacao_municipio)"
_PAYLOAD = f"to_json(struct_pack(a := taxa_alfabetizacao, b := media_portugues, {', '.join(f'{c} := {c}' for c in LEVELS)}))"
_RESULT = ["taxa_alfabetizacao", "media_portugues", *LEVELS]
_DEDUP = f"""d AS (SELECT * FROM (SELECT *, min(h) OVER w mi, max(h) OVER w ma, row_number() OVER (w ORDER BY ingested_at DESC, source_run_id DESC) k
FROM (SELECT *, {_PAYLOAD} h FROM {_M}) WINDOW w AS (PARTITION BY release_id, ano, id_municipio, rede)) WHERE mi = ma AND k = 1)"""


def silver(spark, folder):
    """Silver results: identical copies collapsed, conflicting keys removed."""
    return relational.deduplicate(staged(spark, folder, "silver_municipio"), KEY, _RESULT, ["ingested_at", "source_run_id"])


# scans and projections ------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997")
def partition_extract(spark, folder):
    """Explicit columns of one year, the year bound as a parameter."""
    table(spark, folder, "orders").createOrReplaceTempView("orders_extract")
    return spark.sql(
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders_extract WHERE o_orderdate >= :a AND o_orderdate < :b",
        args={"a": datetime.datetime(1997, 1, 1), "b": datetime.datetime(1998, 1, 1)},
    )


@query("""WITH f AS (SELECT DISTINCT release_id FROM release_registry WHERE status IN ('succeeded', 'active'))
SELECT release_id, count(*) AS n_rows, count(DISTINCT source_run_id) AS n_runs FROM silver_municipio WHERE release_id IN (SELECT release_id FROM f) GROUP BY 1""")
def scan_release_scoped(spark, folder):
    """Rows of the releases a mapping selects, as a semi-join (IN with a subquery)."""
    chosen = table(spark, folder, "release_registry").where(F.col("status").isin("succeeded", "active")).select("release_id")
    rows = table(spark, folder, "silver_municipio").join(chosen, "release_id", "left_semi")
    return rows.groupBy("release_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("source_run_id").alias("n_runs"))


@query("""SELECT c_custkey, TRY_CAST(c_name AS BIGINT) AS name_number, TRY_CAST(right(c_name, 4) AS BIGINT) AS tail_number,
TRY_CAST(right(c_name, 3) AS DECIMAL(28,9)) AS tail_decimal FROM customer""")
def try_cast_dirty(spark, folder):
    tail = lambda n: F.expr(f"right(c_name, {n})")
    return table(spark, folder, "customer").select(
        "c_custkey", F.col("c_name").try_cast("bigint").alias("name_number"), tail(4).try_cast("bigint").alias("tail_number"), tail(3).try_cast("decimal(28,9)").alias("tail_decimal")
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity, 'lineitem' AS table_name FROM lineitem WHERE l_quantity BETWEEN 5 AND 7 AND l_returnflag NOT IN ('A') AND l_linestatus IS DISTINCT FROM 'O'")
def predicates(spark, folder):
    """Range, list and null-safe predicates, all at the scan."""
    rows = table(spark, folder, "lineitem").where(
        F.col("l_quantity").between(5, 7) & ~F.col("l_returnflag").isin("A") & ~F.col("l_linestatus").eqNullSafe("O")
    )
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", F.lit("lineitem").alias("table_name"))


# joins -----------------------------------------------------------------------------------------

@query("""SELECT n_name, r_name, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def dim_enrich_inner(spark, folder):
    small = relational.small_side
    joined = (
        table(spark, folder, "orders").select("o_custkey", "o_totalprice")
        .join(table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
        .join(small(table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")), "c_nationkey")
        .join(small(table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")), "n_regionkey")
    )
    return joined.groupBy("n_name", "r_name").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total")
    )


_LONG = f"""l AS (SELECT release_id, ano ref, id_municipio, rede, CAST(right(nm, 4) AS BIGINT) ym, meta FROM
(SELECT release_id, ano, id_municipio, rede, {', '.join(TARGETS)} FROM {_T}) UNPIVOT (meta FOR nm IN ({', '.join(TARGETS)})))"""
_CHOSEN = f"""{_LONG}, c AS (SELECT release_id, id_municipio, rede, ym, max((ref, meta)) b FROM l WHERE ref <= ym GROUP BY 1, 2, 3, 4),
g AS (SELECT release_id, id_municipio, rede, ym AS ano_meta, struct_extract_at(b, 1) AS ano_referencia, struct_extract_at(b, 2) AS meta_alfabetizacao FROM c)"""


def targets_long(spark, folder, include_nulls=False):
    rows = staged(spark, folder, "silver_meta_alfabetizacao_municipio", "target")
    long = relational.unpivot(rows, KEY, TARGETS, "nome_meta", "meta_alfabetizacao", include_nulls)
    return long.select("release_id", F.col("ano").alias("ano_referencia"), "id_municipio", "rede", F.expr("right(nome_meta, 4)").cast("long").alias("ano_meta"), "meta_alfabetizacao")


def chosen_targets(spark, folder):
    """For each target year the target from the latest reference year not after it."""
    keys = ["release_id", "id_municipio", "rede", "ano_meta"]
    return relational.as_of(targets_long(spark, folder), keys, "ano_referencia", "ano_meta", ["meta_alfabetizacao"])


@query(f"WITH {_LONG} SELECT release_id, ref AS ano_referencia, id_municipio, rede, ym AS ano_meta, meta AS meta_alfabetizacao, count(*) AS n FROM l GROUP BY ALL")
def unpivot_exclude_nulls(spark, folder):
    rows = targets_long(spark, folder)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH l AS (SELECT * FROM (SELECT release_id, {', '.join(TARGETS)} FROM silver_meta_alfabetizacao_municipio) UNPIVOT INCLUDE NULLS (meta FOR nm IN ({', '.join(TARGETS)})))
SELECT CAST(right(nm, 4) AS BIGINT) AS ano_meta, count(*) AS n_rows, count(meta) AS n_values FROM l GROUP BY 1""")
def unpivot_include_nulls(spark, folder):
    return targets_long(spark, folder, True).groupBy("ano_meta").agg(F.count(F.lit(1)).alias("n_rows"), F.count("meta_alfabetizacao").alias("n_values"))


@query(f"WITH {_CHOSEN} SELECT * FROM g")
def asof_latest_reference(spark, folder):
    return chosen_targets(spark, folder)


@query("""SELECT s.id_municipio, count(*) AS n FROM silver_municipio s LEFT JOIN (SELECT DISTINCT id_municipio FROM diretorio_municipio) d USING (id_municipio) WHERE d.id_municipio IS NULL GROUP BY 1""")
def orphan_rows(spark, folder):
    """Result rows whose municipality the directory never had, as written; a null one is an orphan too."""
    rows = table(spark, folder, "silver_municipio").select("id_municipio")
    return relational.orphan_rows(rows, table(spark, folder, "diretorio_municipio"), ["id_municipio"]).groupBy("id_municipio").agg(F.count(F.lit(1)).alias("n"))


# duplicates ------------------------------------------------------------------------------------


@query(f"WITH {_DEDUP} SELECT release_id, ano, id_municipio, rede, {', '.join(_RESULT)} FROM d")
def dedup_payload_hash(spark, folder):
    return silver(spark, folder).select(*KEY, *_RESULT)


_KINDS = f"""k AS (SELECT release_id, ano, id_municipio, rede, count(*) copies, CASE WHEN count(*) = 1 THEN 'single' WHEN count(DISTINCT h) = 1 THEN 'identical' ELSE 'conflicting' END kind
FROM (SELECT *, {_PAYLOAD} h FROM {_M}) GROUP BY 1, 2, 3, 4)"""


def kinds(spark, folder):
    return relational.classify_duplicates(staged(spark, folder, "silver_municipio"), KEY, _RESULT)


@query(f"WITH {_KINDS} SELECT release_id, kind, count(*) AS n_keys, CAST(sum(copies) AS BIGINT) AS n_rows FROM k GROUP BY 1, 2")
def duplicate_classification(spark, folder):
    return kinds(spark, folder).groupBy("release_id", "kind").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("copies").alias("n_rows"))


@query(f"WITH {_KINDS} SELECT release_id, ano, id_municipio, rede, copies FROM k WHERE kind = 'identical'")
def identical_audit(spark, folder):
    return kinds(spark, folder).where("kind = 'identical'").drop("kind")


@query(f"WITH {_KINDS} SELECT release_id, ano, id_municipio, rede, copies FROM k WHERE kind = 'conflicting'")
def conflict_quarantine(spark, folder):
    return kinds(spark, folder).where("kind = 'conflicting'").drop("kind")


@query("""SELECT CAST(sum(c - 1) AS BIGINT) AS excess_rows, 100.0::DOUBLE * sum(c - 1) / sum(c) AS repeated_rate FROM (SELECT count(*) c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def excess_copies_rate(spark, folder):
    return relational.excess_copies(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_key_violations(spark, folder):
    return relational.key_violations(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# windows, order, set operations ----------------------------------------------------------------


@query("""WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) ano, CAST(sum(o_orderkey % 101) % 101 AS BIGINT) v FROM orders GROUP BY 1, 2)
SELECT o_custkey, ano, v, lag(v) OVER (PARTITION BY o_custkey ORDER BY ano) AS v_before FROM y""")
def yearly_lag(spark, folder):
    """Each year's value beside that of the previous year there is."""
    yearly = table(spark, folder, "orders").groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("ano")).agg((F.sum(F.pmod("o_orderkey", F.lit(101))) % 101).alias("v"))
    return relational.previous_available(yearly, ["o_custkey"], "ano", "v", "v_before")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) k FROM events) WHERE k = 1""")
def latest_per_group(spark, folder):
    return relational.latest(table(spark, folder, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])


@query("""SELECT user_id, event_id, k AS place FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) k FROM events) WHERE k <= 3""")
def top_k_per_group(spark, folder):
    """Rank with a limit, which the engine applies before the shuffle too."""
    order = [F.col("value").desc_nulls_last(), F.col("event_id")]
    rows = table(spark, folder, "events").select("user_id", "event_id", "value")
    return relational.ranked(rows, ["user_id"], order, "place").where("place <= 3").select("user_id", "event_id", F.col("place").cast("long").alias("place"))


@query("SELECT status AS pointer, min(release_id) AS release_id FROM release_registry WHERE status IN ('active', 'failed', 'none') GROUP BY 1 HAVING count(*) = 1")
def singleton_guard(spark, folder):
    """A pointer of one row is read, one of several rows or none gives nothing."""
    registry = table(spark, folder, "release_registry").select(F.col("status").alias("pointer"), "release_id")
    return relational.union_all([relational.only_if_single(registry.where(F.col("pointer") == name)) for name in ("active", "failed", "none")])


@query("SELECT o_orderstatus, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest, max(o_totalprice) AS dearest FROM orders GROUP BY 1")
def min_by_lookup(spark, folder):
    return table(spark, folder, "orders").groupBy("o_orderstatus").agg(
        F.min_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("cheapest"), F.max("o_totalprice").alias("dearest")
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_orders(spark, folder):
    """A top-k report."""
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("""SELECT 'region' AS table_name, count(*) AS n_rows FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders""")
def tagged_union(spark, folder):
    names = ["region", "nation", "customer", "supplier", "part", "orders"]
    return relational.union_all([table(spark, folder, n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in names])


@query("""SELECT DISTINCT n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal < 0) AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 9000)""")
def semi_and_anti(spark, folder):
    debtors = table(spark, folder, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("n_nationkey"))
    rich = table(spark, folder, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey"))
    return table(spark, folder, "nation").join(debtors, "n_nationkey", "left_semi").join(rich, "n_nationkey", "left_anti").select("n_name").distinct()


# lineage ---------------------------------------------------------------------------------------

_CHAIN = """r AS (SELECT release_id i, max(trim(baseline_release_id)) b, max(reference_year) y FROM release_registry GROUP BY 1),
c AS (SELECT i, b, y, 0 k FROM r WHERE i = (SELECT max(release_id) FROM release_registry WHERE status = 'active')
UNION ALL SELECT r.i, r.b, r.y, c.k + 1 FROM c JOIN r ON r.i = c.b)"""


def active_chain(spark, folder):
    registry = table(spark, folder, "release_registry")
    return lineage.chain(registry, registry.where("status = 'active'").agg(F.max("release_id")).first()[0])


@query(f"WITH RECURSIVE {_CHAIN} SELECT i AS release_id, y AS reference_year, CAST(k AS BIGINT) AS chain_level FROM c")
def release_chain(spark, folder):
    """The ancestry of the active release."""
    return active_chain(spark, folder).select("release_id", "reference_year", "chain_level")


@query(f"WITH RECURSIVE {_CHAIN} SELECT y AS reference_year, arg_min(i, k) AS release_id, CAST(min(k) AS BIGINT) AS chain_level FROM c GROUP BY 1")
def nearest_release_per_year(spark, folder):
    return lineage.nearest_per_year(active_chain(spark, folder))


# measurements ----------------------------------------------------------------------------------

_NEG = " OR ".join(f"{c} < 0" for c in ["media_portugues", "taxa_alfabetizacao", *LEVELS])
_OUT = " OR ".join(f"{c} IS NULL OR {c} NOT BETWEEN 0 AND 100" for c in ["taxa_alfabetizacao", *LEVELS])
_OUT_T = " OR ".join([f"{c} IS NULL OR {c} NOT BETWEEN 0 AND 100" for c in ("taxa_alfabetizacao", "percentual_participacao")] + [f"{c} NOT BETWEEN 0 AND 100" for c in TARGETS])
_SUM = " + ".join(LEVELS)


@query(f"""SELECT release_id, count(*) AS n_rows, count(*) FILTER ({_OUT}) AS n_outside, count(*) FILTER ({_NEG}) AS n_negative,
count(*) FILTER (({' OR '.join(f'{c} IS NULL' for c in LEVELS)}) OR abs({_SUM} - 100) > 0.5) AS n_proportions FROM silver_municipio GROUP BY 1""")
def result_defects(spark, folder):
    """Ranges, signs and proportion totals of the results, per release."""
    return quality.counts_by_release(
        table(spark, folder, "silver_municipio"), n_outside=quality.range_defects_results(),
        n_negative=quality.negative_defects(["media_portugues", "taxa_alfabetizacao", *LEVELS]), n_proportions=quality.proportion_defects(),
    )


@query(f"SELECT release_id, count(*) AS n_rows, count(*) FILTER ({_OUT_T}) AS n_outside FROM silver_meta_alfabetizacao_municipio GROUP BY 1")
def target_defects(spark, folder):
    return quality.counts_by_release(table(spark, folder, "silver_meta_alfabetizacao_municipio"), n_outside=quality.range_defects_targets())


@query("""WITH s AS (SELECT release_id r, count(*) n, count(*) FILTER (media_portugues IS NULL) x FROM silver_municipio GROUP BY 1),
b AS (SELECT release_id r, max(trim(baseline_release_id)) b FROM release_registry GROUP BY 1)
SELECT s.r AS release_id, s.n AS n_rows, t.n AS base_n_rows, round(100.0::DOUBLE * (s.n - t.n) / t.n, 6) AS volume_delta,
round(100.0::DOUBLE * s.x / s.n - 100.0::DOUBLE * t.x / t.n, 6) AS null_delta FROM s LEFT JOIN b USING (r) LEFT JOIN s t ON t.r = b.b""")
def deltas_vs_baseline(spark, folder):
    """Change of volume and of an optional column's null rate against the baseline."""
    measured = quality.counts_by_release(table(spark, folder, "silver_municipio"), n_null=F.col("media_portugues").isNull())
    both = quality.against_baseline(measured, table(spark, folder, "release_registry"), ["n_rows", "n_null"])
    return both.select(
        "release_id", "n_rows", "base_n_rows", F.round(quality.volume_delta(), 6).alias("volume_delta"), F.round(quality.null_rate_delta("n_null"), 6).alias("null_delta")
    )


@query(f"""WITH k AS (SELECT 'municipio' t, release_id r, ano, id_municipio g, rede FROM silver_municipio UNION ALL SELECT 'meta_municipio', release_id, ano, id_municipio, rede FROM silver_meta_alfabetizacao_municipio
UNION ALL SELECT 'uf', release_id, ano, sigla_uf, rede FROM silver_uf), d AS (SELECT r, sum(n - 1) e FROM (SELECT r, count(*) n FROM k GROUP BY t, r, ano, g, rede) GROUP BY 1)
SELECT k.r AS release_id, count(DISTINCT t) AS covered_tables, round(100.0::DOUBLE * count(*) FILTER (ano IS NULL OR g IS NULL OR g = '' OR rede IS NULL OR rede = '') / count(*), 6) AS null_rate,
round(100.0::DOUBLE * any_value(e) / count(*), 6) AS duplicate_rate FROM k JOIN d ON d.r = k.r GROUP BY 1""")
def key_coverage(spark, folder):
    """Tables covered, null keys and repeated keys of each release, over the tagged union of tables."""
    keys = relational.union_all([
        table(spark, folder, name).select(F.lit(tag).alias("t"), "release_id", "ano", F.col(place).alias("g"), "rede")
        for name, tag, place in (("silver_municipio", "municipio", "id_municipio"), ("silver_meta_alfabetizacao_municipio", "meta_municipio", "id_municipio"), ("silver_uf", "uf", "sigla_uf"))
    ])
    gone = lambda c: F.col(c).isNull() | (F.col(c) == "")
    grouped = keys.groupBy("t", "release_id", "ano", "g", "rede").agg(F.count(F.lit(1)).alias("n"))
    null_key = F.col("ano").isNull() | gone("g") | gone("rede")
    total = F.sum("n")
    return grouped.groupBy("release_id").agg(
        F.countDistinct("t").alias("covered_tables"),
        F.round(F.lit(100.0) * F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)) / total, 6).alias("null_rate"),
        F.round(F.lit(100.0) * F.sum(F.col("n") - 1) / total, 6).alias("duplicate_rate"),
    )


@query("SELECT release_id, id_municipio, media_portugues FROM silver_municipio WHERE media_portugues NOT BETWEEN 0 AND 1000")
def range_violations(spark, folder):
    return relational.range_violations(table(spark, folder, "silver_municipio"), "media_portugues", 0, 1000).select("release_id", "id_municipio", "media_portugues")


@query(f"SELECT release_id, count(*) AS n FROM silver_municipio WHERE abs({' + '.join(f'coalesce({c}, 0)' for c in LEVELS)} - 100) > 0.5 GROUP BY 1")
def proportion_sum(spark, folder):
    """Rows whose proportions do not sum to 100, a null counting as 0."""
    return relational.total_violations(table(spark, folder, "silver_municipio"), LEVELS, 100, 0.5).groupBy("release_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT source, max(date_diff('day', CAST(make_timestamp(epoch_us(verified_at)) AS DATE), DATE '{AS_OF}')) AS oldest_days, count(verified_at) AS n_verified,
count(*) FILTER (verified_at IS NULL) AS n_unverified FROM batch_manifest GROUP BY 1""")
def freshness(spark, folder):
    return table(spark, folder, "batch_manifest").groupBy("source").agg(
        F.max(days_since(F.col("verified_at"), AS_OF)).cast("long").alias("oldest_days"), F.count("verified_at").alias("n_verified"), F.count_if(F.col("verified_at").isNull()).alias("n_unverified")
    )


@query("""SELECT source, year, arg_max(run_id, (completed_at, run_id)) AS run_id FROM batch_manifest WHERE status = 'completed' AND completed_at IS NOT NULL GROUP BY 1, 2""")
def latest_completed_manifest(spark, folder):
    done = table(spark, folder, "batch_manifest").where("status = 'completed' AND completed_at IS NOT NULL")
    return done.groupBy("source", "year").agg(F.max_by("run_id", F.struct("completed_at", "run_id")).alias("run_id"))


_FINGERED = {c: "decimal(28,9)" for c in ("media_portugues", "taxa_alfabetizacao", *LEVELS)} | {
    "ano": "bigint", "ano_particao": "date", "id_municipio": "string", "ingested_at": "timestamp", "rede": "string", "release_id": "string", "serie": "string", "source_run_id": "string",
}


def _fingerprint_sql() -> str:
    value = lambda c, kind: f"CAST({f'epoch_us({c})' if kind == 'timestamp' else c} AS VARCHAR)"
    text = " || ".join(f"'{len(c)}:{c} {kind} ' || coalesce('=' || strlen({value(c, kind)}) || ':' || {value(c, kind)}, '-')" for c, kind in sorted(_FINGERED.items()))
    limbs = ", ".join(f"sum(CAST('0x' || substr({m}, {8 * k + 1}, 8) AS BIGINT)) {m}{k}" for m in "ab" for k in range(8))
    carried = ", ".join(f"{m}{k}" + (f" + {m}t{k + 1} // 4294967296" if k < 7 else "") + f" AS {m}t{k}" for m in "ab" for k in range(7, -1, -1))
    shown = lambda m: " || ".join(f"printf('%08x', CAST({m}t{k} % 4294967296 AS BIGINT))" for k in range(8))
    return f"""WITH t AS (SELECT {text} x FROM silver_municipio), h AS (SELECT sha256('a' || x) a, sha256('b' || x) b FROM t),
s AS (SELECT count(*) n, {limbs} FROM h), c AS (SELECT n, {carried} FROM s) SELECT n AS n_rows, {shown('a')} AS first_sum, {shown('b')} AS second_sum FROM c"""


@query(_fingerprint_sql())
def content_fingerprint(spark, folder):
    """The multiset fingerprint of a table, over all its columns: the row count and both sums."""
    found = fingerprint.multiset_fingerprint(table(spark, folder, "silver_municipio"))
    return spark.createDataFrame([found], "n_rows long, first_sum string, second_sum string")


@query("SELECT source, count(*) AS n_rows, bit_xor(CAST('0x' || md5(run_id || '|' || line_no || '|' || coalesce(payload, ''))[:15] AS BIGINT)) AS fingerprint FROM landing_record JOIN (SELECT run_id, min(source) source FROM batch_manifest GROUP BY 1) USING (run_id) GROUP BY 1")
def xor_fingerprints(spark, folder):
    """The legacy fingerprint: exclusive or of row hashes, in which pairs of equal rows cancel, per source."""
    runs = table(spark, folder, "batch_manifest").groupBy("run_id").agg(F.min("source").alias("source"))
    digest = F.md5(F.concat(F.col("run_id"), F.lit("|"), F.col("line_no").cast("string"), F.lit("|"), F.coalesce("payload", F.lit(""))))
    rows = table(spark, folder, "landing_record").join(runs, "run_id").select("source", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("h"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor("h").alias("fingerprint"))


# streams, as their settled batch form ----------------------------------------------------------

_STREAM = "(SELECT *, epoch_us(CAST(event_time AS TIMESTAMPTZ)) et, lower(event_id) eid, CASE WHEN message_id IS NULL THEN delivery_id END om, CASE WHEN event_id IS NULL THEN delivery_id END oe FROM municipal_rate_stream)"
_TRANSPORT = f"""tr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY message_id, om ORDER BY ingestion_time DESC NULLS LAST, publish_time DESC, et DESC, eid DESC NULLS LAST, delivery_id DESC) k FROM {_STREAM}) WHERE k = 1)"""
_LOGICAL = f"""{_TRANSPORT}, lg AS (SELECT *, row_number() OVER (PARTITION BY eid, oe ORDER BY et DESC, publish_time DESC, ingestion_time DESC NULLS LAST, message_id DESC NULLS LAST, delivery_id DESC) g FROM tr)"""


MESSAGE, EVENT = ["message_id", "own_message"], ["eid", "own_event"]
EVENT_ORDER = ["et", "publish_time", "ingestion_time", "message_id", "delivery_id"]


def stream_rows(spark, folder):
    """All rows. Nulls link nothing: a row without message id is a message of its own, one without
    event id an event of its own, told apart by its delivery id."""
    rows = table(spark, folder, "municipal_rate_stream")
    own = lambda c: F.when(F.col(c).isNull(), F.col("delivery_id"))
    return rows.withColumns({
        "et": micros(instant(F.col("event_time"))), "eid": F.lower("event_id"), "own_message": own("message_id"), "own_event": own("event_id"),
    })


def transport_latest(spark, folder):
    """Of each message the last delivery."""
    rows = stream_rows(spark, folder)
    return relational.latest(rows, MESSAGE, ["ingestion_time", "publish_time", "et", "eid", "delivery_id"])


@query(f"WITH {_TRANSPORT} SELECT message_id, delivery_id FROM tr")
def stream_transport_dedup(spark, folder):
    return transport_latest(spark, folder).select("message_id", "delivery_id")


@query(f"WITH {_LOGICAL} SELECT eid AS event_id, delivery_id, taxa_alfabetizacao FROM lg WHERE g = 1")
def stream_latest(spark, folder):
    rows = relational.latest(transport_latest(spark, folder), EVENT, EVENT_ORDER, ["delivery_id", "taxa_alfabetizacao"])
    return rows.select(F.col("eid").alias("event_id"), "delivery_id", "taxa_alfabetizacao")


@query(f"WITH {_LOGICAL} SELECT eid AS event_id, message_id, delivery_id FROM lg WHERE g > 1")
def stream_audit(spark, folder):
    """The copies that the latest version of each event replaced: all but that one, so no event's copies
    are ranked in one task."""
    messages = transport_latest(spark, folder)
    kept = relational.latest(messages, EVENT, EVENT_ORDER, ["delivery_id"]).select("delivery_id")
    return messages.join(kept, "delivery_id", "left_anti").select(F.col("eid").alias("event_id"), "message_id", "delivery_id")


@query("""WITH h AS (SELECT *, event_id % 2 s FROM events), c AS (SELECT user_id, event_type, max((ts, event_id, value)) m FROM h WHERE s = 0 GROUP BY 1, 2),
i AS (SELECT user_id, event_type, max((ts, event_id, value)) m FROM h WHERE s = 1 GROUP BY 1, 2)
SELECT user_id, event_type, CASE WHEN c.m IS NULL OR struct_extract_at(i.m, 1) >= struct_extract_at(c.m, 1) THEN struct_extract_at(i.m, 3) ELSE struct_extract_at(c.m, 3) END AS value FROM c FULL JOIN i USING (user_id, event_type)""")
def current_value_merge(spark, folder):
    """Upsert of incoming values that are as new or newer than the current ones."""
    rows = table(spark, folder, "events")
    last = lambda k: relational.latest(rows.where(F.pmod("event_id", F.lit(2)) == k), ["user_id", "event_type"], ["ts", "event_id", "value"], ["ts", "value"])
    return relational.merge_upsert(last(0), last(1), ["user_id", "event_type"], "ts").select("user_id", "event_type", "value")


@query("""SELECT rede, round(quantile_cont(epoch_us(coalesce(ingestion_time, publish_time)) - epoch_us(CAST(event_time AS TIMESTAMPTZ)), 0.95), 3) AS p95_us FROM municipal_rate_stream GROUP BY 1""")
def latency_p95(spark, folder):
    """The exact interpolated 95th percentile of the delay per network."""
    delay = micros(F.coalesce("ingestion_time", "publish_time")) - micros(instant(F.col("event_time")))
    return table(spark, folder, "municipal_rate_stream").groupBy("rede").agg(F.round(F.percentile(delay, 0.95), 3).alias("p95_us"))


_VALID = """ano BETWEEN 2000 AND 2100 AND regexp_full_match(id_municipio, '[0-9]{7}') AND id_municipio <> '0000000' AND rede IN ('total', 'estadual', 'municipal', 'publica')
AND taxa_alfabetizacao BETWEEN 0 AND 100 AND (taxa_participacao IS NULL OR taxa_participacao BETWEEN 0 AND 100) AND simulation
AND regexp_full_match(lower(event_id), '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}') AND length(correlation_id) BETWEEN 1 AND 128 AND regexp_matches(event_time, '(Z|[+]00:00)$')"""


@query(f"SELECT delivery_id, CASE WHEN coalesce({_VALID}, false) THEN 'valid' ELSE 'quarantine' END AS route FROM municipal_rate_stream")
def event_semantic_validation(spark, folder):
    from tessera.streaming.routing import semantic_rules

    rows = table(spark, folder, "municipal_rate_stream").withColumn("participacao", F.col("taxa_participacao"))
    return rows.select("delivery_id", F.when(semantic_rules(rows), "valid").otherwise("quarantine").alias("route"))


@query(f"SELECT delivery_id, CASE WHEN coalesce({_VALID}, false) THEN 'valid' ELSE 'quarantine' END AS route FROM municipal_rate_stream")
def event_routing(spark, folder):
    """The same through the binary codec: rows are encoded, delivered as envelopes, decoded and routed; a
    row that is no record of the schema has no payload to decode."""
    from tessera.streaming import demo, routing

    fixed = {"schema_version": F.lit(routing.SCHEMA_VERSION), "event_type": F.lit(routing.EVENT_TYPE), "producer": F.lit("catalogue"), "participacao": F.col("taxa_participacao")}
    columns = {name: fixed.get(name, F.col(name)) for name, _ in routing.EVENT_FIELDS if name in fixed or name != "participacao"}
    rows = table(spark, folder, "municipal_rate_stream").select(
        F.col("delivery_id").cast("string").alias("message_id"), demo.encoded(columns).alias("payload"), "publish_time", "ingestion_time", "correlation_id"
    )
    routed = routing.route(rows)
    return routed.select(F.col("message_id").cast("long").alias("delivery_id"), F.when(F.col("valid"), "valid").otherwise("quarantine").alias("route"))


@query("SELECT DISTINCT message_id FROM municipal_rate_stream")
def distinct_messages(spark, folder):
    return table(spark, folder, "municipal_rate_stream").dropDuplicates(["message_id"]).select("message_id")


@query("SELECT 'stored' AS part, count(*) FILTER (taxa_alfabetizacao > 100) = 0 AS within FROM silver_municipio UNION ALL SELECT 'nothing', count(*) FILTER (taxa_alfabetizacao > 100) = 0 FROM silver_municipio WHERE ano = -1")
def boolean_aggregate(spark, folder):
    """A yes or no about all rows; about no rows there is an answer too."""
    rows = table(spark, folder, "silver_municipio")
    says = lambda part, name: part.agg(F.lit(name).alias("part"), (F.count_if(F.col("taxa_alfabetizacao") > 100) == 0).alias("within"))
    return says(rows, "stored").unionByName(says(rows.where("ano = -1"), "nothing"))
