"""Queries p1_ to p7_ over the tables of a data folder, and the SQL their results are checked with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import day_text, micros, trimmed
from tessera.operators import copies, equality_delete, hierarchy, late_events, orphans, profiling, schema_drift
from tessera.session import cut, new_table_path
from tessera.streaming import late_state


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# 1 ---------------------------------------------------------------------------------------------


def _late_store(spark, folder):
    """The state after the stream has arrived in three batches."""
    return late_state.replay(late_events.stream_rows(table(spark, folder, "municipal_rate_stream")))


def p1_found(spark, folder):
    """The log of adjustments of the state."""
    return _late_store(spark, folder).corrections().select(F.col("row_id").alias("delivery_id"), day_text(F.col("period")).alias("event_day"), "fate")


def p1_corrections(spark, folder):
    """What the adjustments did to the count of each value of a day."""
    store = _late_store(spark, folder)
    counted = late_events.correction_counts(store.state(), store.corrections())
    return counted.select(day_text(F.col("period")).alias("event_day"), "value", "n_closed", "n_correction", "n_dropped", "n")


def p1_daily(spark, folder):
    """Each day's aggregates as corrected, and its median as it stood when the day closed."""
    store = _late_store(spark, folder)
    state = cut(store.state(), "state")
    dropped = store.corrections().where(F.col("fate") == late_events.DROPPED).select("period", F.lit(-1).alias("revision"), F.lit(1).cast("long").alias("n"))
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0).cast("long"))
    revision = F.col("revision")
    counted = state.select("period", "revision", "n").unionByName(dropped).groupBy("period").agg(
        total(revision == 0).alias("n_on_time"), total(revision > 0).alias("n_correction"), total(revision < 0).alias("n_dropped")
    )
    final = late_events.aggregates(state.groupBy("period", "value").agg(F.sum("n").alias("n")))
    closed = late_events.aggregates(state.where("revision = 0").select("period", "value", "n"))
    closed = closed.select("period", F.col("median_value").alias("closed_median"))
    return counted.join(final, "period", "left").join(closed, "period", "left").select(
        day_text(F.col("period")).alias("event_day"), "n_on_time", "n_correction", "n_dropped", F.coalesce("n_values", F.lit(0)).alias("n_values"),
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "min_value", "max_value",
        F.round("median_value", 6).alias("median_value"), F.round("closed_median", 6).alias("closed_median"),
    )


def p1_revisions(spark, folder):
    """Each day's aggregates as they stood on the day itself and on the days after, up to the cut-off."""
    store = _late_store(spark, folder)
    grown = late_events.revisions(store.state(), -(-store.policy.cutoff_hours // 24))
    return late_events.aggregates(cut(grown, "revisions"), "period", "revision").select(
        day_text(F.col("period")).alias("event_day"), F.col("revision").cast("long").alias("revision"), "n_rows", "n_distinct",
        "min_value", "max_value", F.round("median_value", 6).alias("median_value"),
    )


_LATE_SQL = """
WITH r AS (SELECT delivery_id, taxa_alfabetizacao v, epoch_us(CAST(event_time AS TIMESTAMPTZ)) e,
                  epoch_us(coalesce(ingestion_time, publish_time)) a FROM municipal_rate_stream),
f AS (SELECT delivery_id, v, e // 86400000000 d, a // 86400000000 - e // 86400000000 rev,
             CASE WHEN a < (e // 86400000000 + 1) * 86400000000 THEN 'on_time'
                  WHEN a - e > 72 * 3600000000 THEN 'dropped' ELSE 'correction' END fate FROM r)
"""
_DAY_SQL = "strftime(make_timestamp(d * 86400000000), '%Y-%m-%d')"

P1_SQL = {
    "p1_found": _LATE_SQL + f"SELECT delivery_id, {_DAY_SQL} AS event_day, fate FROM f WHERE fate <> 'on_time'",
    "p1_corrections": _LATE_SQL + f"""
SELECT {_DAY_SQL} AS event_day, v AS value, count(*) FILTER (fate = 'on_time') AS n_closed, count(*) FILTER (fate = 'correction') AS n_correction,
  count(*) FILTER (fate = 'dropped') AS n_dropped, count(*) FILTER (fate <> 'dropped') AS n FROM f GROUP BY d, v HAVING count(*) FILTER (fate <> 'on_time') > 0""",
    "p1_daily": _LATE_SQL + f"""
SELECT {_DAY_SQL} AS event_day, count(*) FILTER (fate = 'on_time') AS n_on_time, count(*) FILTER (fate = 'correction') AS n_correction,
  count(*) FILTER (fate = 'dropped') AS n_dropped, count(v) FILTER (fate <> 'dropped') AS n_values,
  count(DISTINCT v) FILTER (fate <> 'dropped') AS n_distinct, min(v) FILTER (fate <> 'dropped') AS min_value,
  max(v) FILTER (fate <> 'dropped') AS max_value, round(median(CAST(v AS DOUBLE)) FILTER (fate <> 'dropped'), 6) AS median_value,
  round(median(CAST(v AS DOUBLE)) FILTER (fate = 'on_time'), 6) AS closed_median
FROM f GROUP BY d""",
    "p1_revisions": _LATE_SQL + f""", g AS (SELECT d, v, CASE WHEN fate = 'on_time' THEN 0 ELSE rev END rev FROM f WHERE fate <> 'dropped'),
s AS (SELECT d, v, k FROM g JOIN (SELECT unnest([0, 1, 2, 3]) k) ON k >= rev)
SELECT {_DAY_SQL} AS event_day, CAST(k AS BIGINT) AS revision, count(*) AS n_rows, count(DISTINCT v) AS n_distinct, min(v) AS min_value,
  max(v) AS max_value, round(median(CAST(v AS DOUBLE)), 6) AS median_value FROM s GROUP BY d, k""",
}

# 2 ---------------------------------------------------------------------------------------------


def p2_found(spark, folder):
    return schema_drift.changes(table(spark, folder, "source_inspection"), table(spark, folder, "batch_manifest"))


def p2_fused(spark, folder):
    """The fused schema: every alternative type of every path of a source, and where it appeared."""
    return schema_drift.declared_alternatives(table(spark, folder, "source_inspection"), table(spark, folder, "batch_manifest"))


def _drifting(spark, folder):
    return [table(spark, folder, name) for name in ("landing_record", "source_inspection", "batch_manifest")]


def p2_alternatives(spark, folder):
    """Every alternative that the records show of a path: how often, where first, and if it was declared."""
    return schema_drift.observed_alternatives(*_drifting(spark, folder))


def p2_hashes(spark, folder):
    """Runs whose schema hash did not follow their columns, or changed without them."""
    return schema_drift.hash_findings(table(spark, folder, "source_inspection"), table(spark, folder, "batch_manifest"))


def p2_table(spark, folder):
    """All values of all records of all files in one schema."""
    return schema_drift.consistent_values(*_drifting(spark, folder))


def p2_wide(spark, folder):
    """The same as one wide table, renamed columns joined; its columns are those of the data."""
    wide = schema_drift.consistent_table(*_drifting(spark, folder))
    return wide.withColumn("unconverted_", F.to_json("unconverted_"))


_SCHEMA_SQL = """
WITH runs AS (SELECT run_id, min(source) source, min(year) AS year, min(started_at) t FROM batch_manifest WHERE status = 'completed' GROUP BY 1),
o AS (SELECT *, lag(run_id) OVER (PARTITION BY source, year ORDER BY t, run_id) p FROM runs),
c AS (SELECT DISTINCT run_id, lower(column_name) n, ordinal k, column_mode m,
        CASE data_type WHEN 'INTEGER' THEN 'INT64' WHEN 'FLOAT' THEN 'FLOAT64' ELSE data_type END t FROM source_inspection)
"""

_CHANGE_SQL = _SCHEMA_SQL.rstrip() + """, now AS (SELECT o.run_id r, o.p, c.* FROM o JOIN c USING (run_id) WHERE p IS NOT NULL),
was AS (SELECT o.run_id r, c.* FROM o JOIN c ON c.run_id = o.p),
new AS (SELECT now.* FROM now LEFT JOIN was ON was.r = now.r AND was.n = now.n WHERE was.n IS NULL),
gone AS (SELECT was.* FROM was LEFT JOIN now ON was.r = now.r AND was.n = now.n WHERE now.n IS NULL),
ren AS (SELECT new.r, new.n, gone.n old FROM new JOIN gone ON new.r = gone.r AND new.k = gone.k AND new.t = gone.t),
ch AS (SELECT r AS run_id, 'renamed' AS change_kind, n AS column_name, old AS prior_name FROM ren
UNION SELECT r, 'added', n, '' FROM new WHERE (r, n) NOT IN (SELECT r, n FROM ren)
UNION SELECT r, 'removed', n, '' FROM gone WHERE (r, n) NOT IN (SELECT r, old FROM ren)
UNION SELECT now.r, 'retyped', now.n, '' FROM now JOIN was ON was.r = now.r AND was.n = now.n WHERE was.t <> now.t
UNION SELECT now.r, 'mode_changed', now.n, '' FROM now JOIN was ON was.r = now.r AND was.n = now.n WHERE was.m <> now.m)
"""
_VALUE_SQL = _SCHEMA_SQL.rstrip() + """, src AS (SELECT run_id, min(source) source FROM (SELECT run_id, source FROM source_inspection UNION ALL SELECT run_id, source FROM batch_manifest) GROUP BY 1),
l AS (SELECT *, doc IS NOT NULL good FROM (SELECT *, CASE WHEN json_valid(payload) THEN CASE WHEN json_type(payload) = 'OBJECT' THEN payload END END doc FROM landing_record)),
v AS (SELECT run_id, line_no, regexp_replace(lower(trim(substr(fullkey, 3))), '\\[[0-9]+\\]', '[]', 'g') AS path,
  CASE WHEN type IN ('UBIGINT', 'BIGINT') THEN 'INT64' WHEN type IN ('DOUBLE', 'HUGEINT', 'UHUGEINT') THEN 'FLOAT64' WHEN type = 'VARCHAR' THEN 'STRING' WHEN type = 'BOOLEAN' THEN 'BOOL' ELSE type END tag,
  CASE WHEN type NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN doc ->> fullkey END x FROM l, json_tree(coalesce(l.doc, '{}')) WHERE fullkey <> '$'),
w AS (SELECT v.*, source, regexp_extract(path, '^[^.\\[]*') column_name FROM v LEFT JOIN src USING (run_id)),
de AS (SELECT o.source, c.n, c.t, count(*) k FROM c JOIN o USING (run_id) GROUP BY 1, 2, 3)
"""

P2_SQL = {
    "p2_found": _CHANGE_SQL + "SELECT * FROM ch",
    "p2_hashes": _CHANGE_SQL.rstrip() + """, hs AS (SELECT run_id, max(schema_hash) h FROM batch_manifest WHERE status = 'completed' GROUP BY 1),
d AS (SELECT o.run_id, a.h IS DISTINCT FROM b.h hc, o.run_id IN (SELECT run_id FROM ch) cc FROM o JOIN hs a ON a.run_id = o.run_id JOIN hs b ON b.run_id = o.p)
SELECT run_id, CASE WHEN cc THEN 'stale_hash' ELSE 'unexplained_hash' END AS finding FROM d WHERE hc <> cc""",
    "p2_alternatives": _VALUE_SQL.rstrip() + """, s AS (SELECT run_id, min(started_at) t FROM batch_manifest GROUP BY 1),
p AS (SELECT source, path, tag, run_id, count(*) n FROM w WHERE tag <> 'NULL' GROUP BY ALL)
SELECT p.source, path, tag, CAST(sum(p.n) AS BIGINT) AS n_values, count(*) AS n_runs, arg_min(run_id, (coalesce(s.t, TIMESTAMP '0001-01-01'), run_id)) AS first_run, bool_or(de.k IS NOT NULL) AS declared
FROM p LEFT JOIN s USING (run_id) LEFT JOIN de ON de.source = p.source AND de.n = path AND de.t = tag GROUP BY 1, 2, 3""",
    "p2_table": _VALUE_SQL.rstrip() + """, wi AS (SELECT source, n path, max(CASE t WHEN 'INT64' THEN 0 WHEN 'FLOAT64' THEN 1 ELSE 2 END) q, 0 k FROM de GROUP BY 1, 2
  UNION ALL SELECT source, path, max(CASE tag WHEN 'INT64' THEN 0 WHEN 'FLOAT64' THEN 1 ELSE 2 END), 1 FROM w WHERE tag <> 'NULL' GROUP BY 1, 2),
f AS (SELECT source, path, ['INT64', 'FLOAT64', 'STRING'][arg_min(q, k) + 1] ft FROM wi GROUP BY 1, 2),
j AS (SELECT w.*, ft, CASE WHEN tag IN ('INT64', 'FLOAT64', 'STRING') AND regexp_full_match(replace(trim(x), ',', '.'), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN replace(trim(x), ',', '.') END num
  FROM w LEFT JOIN f USING (source, path))
SELECT run_id, line_no, source, column_name, path, tag, ft AS fused_type, CASE WHEN tag = 'INT64' THEN TRY_CAST(x AS BIGINT) END AS as_int64, CASE WHEN tag = 'FLOAT64' THEN TRY_CAST(x AS DOUBLE) END AS as_float64,
  CASE WHEN tag IN ('STRING', 'BOOL') THEN x END AS as_string,
  CASE WHEN ft = 'INT64' THEN CASE WHEN regexp_full_match(num, '[+-]?[0-9]+') THEN TRY_CAST(num AS BIGINT) WHEN CAST(num AS DOUBLE) = floor(CAST(num AS DOUBLE)) AND abs(CAST(num AS DOUBLE)) <= 9007199254740992 THEN CAST(CAST(num AS DOUBLE) AS BIGINT) END END AS canonical_int64,
  CASE WHEN ft = 'FLOAT64' THEN TRY_CAST(num AS DOUBLE) END AS canonical_float64, CASE WHEN ft = 'STRING' THEN CASE WHEN tag = 'FLOAT64' THEN regexp_replace(x, '[.]?0+$', '') ELSE x END END AS canonical_string FROM j
UNION ALL SELECT run_id, line_no, source, '', '', 'BROKEN', NULL, NULL, NULL, payload, NULL, NULL, NULL FROM l LEFT JOIN src USING (run_id) WHERE NOT good""",
    "p2_fused": _SCHEMA_SQL + """
SELECT o.source, c.n AS column_name, c.t AS data_type, count(*) AS n_runs, arg_min(o.run_id, (o.t, o.run_id)) AS first_run
FROM c JOIN o USING (run_id) GROUP BY 1, 2, 3""",
}

# 3 ---------------------------------------------------------------------------------------------


def p3_found(spark, folder):
    changes = equality_delete.change_rows(table(spark, folder, "municipal_rate_stream"))
    return equality_delete.current_rows(changes).select(*equality_delete.KEYS, F.col("seq.seq_id").alias("delivery_id"))


def p3_current(spark, folder):
    """The table of current rates."""
    changes = equality_delete.change_rows(table(spark, folder, "municipal_rate_stream"))
    return equality_delete.current_rows(changes).select(*equality_delete.KEYS, F.col("value").alias("taxa_alfabetizacao"))


def p3_batches(spark, folder):
    """The same through the table of appended files: the feed in three batches by delivery, out of
    order, the middle one twice, compacted after the second."""
    changes = equality_delete.change_rows(table(spark, folder, "municipal_rate_stream"))
    store = equality_delete.EqualityDeleteTable(spark, new_table_path(spark, "rates"))
    part = F.pmod(F.xxhash64("seq_id"), F.lit(3))
    for k in (1, 2, 1):
        store.append(changes.where(part == k), f"batch-{k}")
    store.compact("compacted")
    store.append(changes.where(part == 0), "batch-0")
    return store.read().select(*equality_delete.KEYS, F.col("value").alias("taxa_alfabetizacao"))


_LAST_SQL = """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY ano, id_municipio, rede
  ORDER BY epoch_us(CAST(event_time AS TIMESTAMPTZ)) DESC, publish_time DESC, delivery_id DESC) k FROM municipal_rate_stream)
SELECT ano, id_municipio, rede, {} FROM l WHERE k = 1 AND upper(change_op[1]) <> 'D'"""

P3_SQL = {
    "p3_found": _LAST_SQL.format("delivery_id"),
    "p3_current": _LAST_SQL.format("taxa_alfabetizacao"),
    "p3_batches": _LAST_SQL.format("taxa_alfabetizacao"),
}

# 4 ---------------------------------------------------------------------------------------------


def _releases(spark, folder, with_path):
    return hierarchy.hierarchy(table(spark, folder, "release_registry"), "release_id", "baseline_release_id", with_path=with_path)


def p4_found(spark, folder):
    return _releases(spark, folder, False).select(F.col("node").alias("release_id"), F.col("root").alias("root_release_id"), "depth")


def p4_hierarchy(spark, folder):
    """Path, depth, root and number of descendants of every release with a proper root."""
    tree = _releases(spark, folder, True).where("depth >= 0")
    return tree.select(
        F.col("node").alias("release_id"), F.col("root").alias("root_release_id"), "depth",
        (F.col("size") - 1).alias("n_descendants"), F.array_join("path", "/").alias("path"),
    )


def p4_descendants(spark, folder):
    """All descendants of every release."""
    return hierarchy.descendants(_releases(spark, folder, False)).select(F.col("ancestor").alias("release_id"), F.col("descendant").alias("descendant_id"))


_TREE_SQL = """
WITH RECURSIVE n AS (SELECT release_id r, max(trim(baseline_release_id)) b FROM release_registry GROUP BY 1),
l AS (SELECT n.r, k.r p FROM n LEFT JOIN n k ON k.r = n.b),
t AS (SELECT r, r root, 0 depth, r path FROM l WHERE p IS NULL
      UNION ALL SELECT l.r, t.root, t.depth + 1, t.path || '/' || l.r FROM l JOIN t ON l.p = t.r)
"""

P4_SQL = {
    "p4_found": _TREE_SQL + """, bad AS (SELECT r, p FROM l WHERE r NOT IN (SELECT r FROM t)),
w AS (SELECT r, p AS y FROM bad UNION SELECT w.r, bad.p FROM w JOIN bad ON bad.r = w.y),
cyc AS (SELECT r FROM w WHERE y = r)
SELECT r AS release_id, root AS root_release_id, CAST(depth AS BIGINT) AS depth FROM t
UNION ALL SELECT r, min(y), -1 FROM w WHERE y IN (SELECT r FROM cyc) GROUP BY r""",
    "p4_hierarchy": _TREE_SQL + """, a AS (SELECT r, unnest(string_split(path, '/')) x FROM t)
SELECT t.r AS release_id, root AS root_release_id, CAST(depth AS BIGINT) AS depth, CAST(c.n - 1 AS BIGINT) AS n_descendants, path
FROM t JOIN (SELECT x, count(*) n FROM a GROUP BY x) c ON c.x = t.r""",
    "p4_descendants": _TREE_SQL + """, a AS (SELECT r, unnest(string_split(path, '/')) x FROM t)
SELECT x AS release_id, r AS descendant_id FROM a WHERE x <> r""",
}

# 5 ---------------------------------------------------------------------------------------------


def _reference_state(spark, folder):
    """The state of all references after two batches: what was stored and known up to the middle of the
    days of arrival, and the rest, with parents that came, went or changed in between."""
    day = F.date_from_unix_date(F.call_function("div", micros(F.col("ingested_at")), F.lit(86_400_000_000)).cast("int")).alias("day")
    directory = table(spark, folder, "diretorio_municipio")
    span = (F.col("incluido_em").alias("valid_from"), F.col("excluido_em").alias("valid_to"))

    def references(name, key):
        return table(spark, folder, name).select(F.lit(name).alias("table_name"), "release_id", "ano", key.alias("ref_key"), day)

    municipal = references("silver_municipio", trimmed(F.col("id_municipio"))).unionByName(
        references("silver_meta_alfabetizacao_municipio", trimmed(F.col("id_municipio")))
    )
    federal = references("silver_uf", F.upper(trimmed(F.col("sigla_uf"))))
    states = [
        orphans.replay(rows, directory.select(F.col(key).alias("key"), *span)).state() for rows, key in ((municipal, "id_municipio"), (federal, "sigla_uf"))
    ]
    return states[0].unionByName(states[1])


def p5_found(spark, folder):
    return orphans.found(_reference_state(spark, folder))


def p5_pending(spark, folder):
    """Per table and period: references that opened as orphans, how many of them a later parent
    resolved, and references whose parent was removed after they arrived."""
    state = _reference_state(spark, folder)
    zero = F.lit(0).cast("long")
    return state.groupBy("table_name", "ano").agg(
        F.sum("n").alias("n_references"),
        F.coalesce(F.sum(F.when(F.col("opened"), F.col("n"))), zero).alias("n_opened"),
        F.coalesce(F.sum(F.when(F.col("resolved_on").isNotNull(), F.col("n"))), zero).alias("n_resolved"),
        F.coalesce(F.sum(F.when(F.col("removed_on").isNotNull(), F.col("n"))), zero).alias("n_reopened"),
    )


SNAPSHOT_DAYS = ["2025-03-31", "2025-06-30", "2025-09-30", "2025-12-31"]


def p5_snapshots(spark, folder):
    """Open orphans per table and period at the ends of quarters."""
    return orphans.snapshots(_reference_state(spark, folder), SNAPSHOT_DAYS).withColumn("snapshot_day", F.col("snapshot_day").cast("string"))


_REFERENCE_SQL = """
WITH r AS (SELECT 'silver_municipio' AS table_name, release_id, ano, trim(id_municipio) k, CAST(make_timestamp(epoch_us(ingested_at)) AS DATE) d FROM silver_municipio
UNION ALL SELECT 'silver_meta_alfabetizacao_municipio', release_id, ano, trim(id_municipio), CAST(make_timestamp(epoch_us(ingested_at)) AS DATE) FROM silver_meta_alfabetizacao_municipio
UNION ALL SELECT 'silver_uf', release_id, ano, upper(trim(sigla_uf)), CAST(make_timestamp(epoch_us(ingested_at)) AS DATE) FROM silver_uf),
p AS (SELECT id_municipio k, 'm' kind, incluido_em a, excluido_em b FROM diretorio_municipio UNION ALL SELECT sigla_uf, 'u', incluido_em, excluido_em FROM diretorio_municipio),
q AS (SELECT *, CASE table_name WHEN 'silver_uf' THEN 'u' ELSE 'm' END kind FROM r WHERE k IS NOT NULL),
g AS (SELECT table_name, release_id, ano, k, kind, d, count(*) n FROM q GROUP BY ALL)
"""
_HOLDS = "p.k = {0}.k AND p.kind = {0}.kind AND (p.a IS NULL OR p.a <= {1}) AND (p.b IS NULL OR p.b > {1})"

P5_SQL = {
    "p5_pending": _REFERENCE_SQL + f""", e AS (SELECT table_name, ano, n, d, EXISTS (SELECT 1 FROM p WHERE {_HOLDS.format('g', 'g.d')}) held,
  EXISTS (SELECT 1 FROM p WHERE p.k = g.k AND p.kind = g.kind AND p.a > g.d AND (p.b IS NULL OR p.b > p.a)) later,
  EXISTS (SELECT 1 FROM p WHERE p.k = g.k AND p.kind = g.kind AND p.b > g.d AND (p.a IS NULL OR p.a < p.b)
    AND NOT EXISTS (SELECT 1 FROM p z WHERE z.k = p.k AND z.kind = p.kind AND (z.a IS NULL OR z.a <= p.b) AND (z.b IS NULL OR z.b > p.b))) gone FROM g)
SELECT table_name, ano, CAST(sum(n) AS BIGINT) AS n_references, CAST(coalesce(sum(n) FILTER (NOT held), 0) AS BIGINT) AS n_opened,
  CAST(coalesce(sum(n) FILTER (NOT held AND later), 0) AS BIGINT) AS n_resolved, CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS n_reopened FROM e GROUP BY 1, 2""",
    "p5_found": _REFERENCE_SQL + f"SELECT DISTINCT table_name, release_id, ano, k AS ref_key FROM g WHERE NOT EXISTS (SELECT 1 FROM p WHERE {_HOLDS.format('g', 'g.d')})",
    "p5_snapshots": _REFERENCE_SQL + f""", s AS (SELECT unnest({SNAPSHOT_DAYS}::DATE[]) x),
h AS (SELECT g.*, x FROM g JOIN s ON g.d <= x)
SELECT table_name, ano, CAST(x AS VARCHAR) AS snapshot_day, CAST(sum(n) AS BIGINT) AS open_references, count(DISTINCT k) AS open_keys
FROM h WHERE NOT EXISTS (SELECT 1 FROM p WHERE {_HOLDS.format('h', 'h.x')}) GROUP BY 1, 2, 3""",
}

# 6 ---------------------------------------------------------------------------------------------


def p6_found(spark, folder):
    rows = copies.message_rows(table(spark, folder, "municipal_rate_stream"))
    return copies.replay(rows).select(F.col("row_id").alias("delivery_id"))


def p6_once(spark, folder):
    """The same as one batch, by an empty store."""
    rows = copies.message_rows(table(spark, folder, "municipal_rate_stream"))
    return copies.replay(rows, batches=1).select(F.col("row_id").alias("delivery_id"))


_COPIES_SQL = """
WITH RECURSIVE r AS (SELECT delivery_id d, message_id m, lower(event_id) e, epoch_us(CAST(event_time AS TIMESTAMPTZ)) t,
  epoch_us(coalesce(ingestion_time, publish_time)) a FROM municipal_rate_stream),
e AS (SELECT d u, lag(d) OVER (PARTITION BY m ORDER BY a, d) v FROM r WHERE m IS NOT NULL
      UNION ALL SELECT d, lag(d) OVER (PARTITION BY e, t ORDER BY a, d) FROM r WHERE e IS NOT NULL),
b AS (SELECT u, v FROM e WHERE v IS NOT NULL UNION SELECT v, u FROM e WHERE v IS NOT NULL),
w AS (SELECT u x, v y FROM b UNION SELECT w.x, b.v FROM w JOIN b ON b.u = w.y)
SELECT DISTINCT x AS delivery_id FROM w JOIN r p ON p.d = w.x JOIN r q ON q.d = w.y WHERE (q.a, q.d) < (p.a, p.d)"""

P6_SQL = {"p6_found": _COPIES_SQL, "p6_once": _COPIES_SQL}

# 7 ---------------------------------------------------------------------------------------------


def _compared(spark, folder):
    profile = profiling.numeric_profile(table(spark, folder, "silver_municipio"), "release_id", profiling.SILVER_EXPECTATIONS)
    # a row per load and column, read for the load itself and for whatever was built on it
    return profiling.with_baseline(cut(profile, "profile"), table(spark, folder, "release_registry"), profiling.SILVER_EXPECTATIONS)


def p7_found(spark, folder):
    return profiling.findings(_compared(spark, folder)).select(F.col("load").alias("release_id"), "column_name", "finding")


def p7_profile(spark, folder):
    """Every column of every load."""
    patterns = {"id_municipio": r"\A[0-9]{7}\z", **{c: e.pattern for c, e in profiling.SILVER_EXPECTATIONS.items()}}
    return profiling.profile_all(table(spark, folder, "silver_municipio"), "release_id", patterns).withColumnRenamed("load", "release_id")


def p7_shifts(spark, folder):
    """Standardised difference of each load's mean from that of the load it was built on."""
    pooled = F.sqrt((F.col("sd") * F.col("sd") + F.col("base_sd") * F.col("base_sd")) / 2)
    return _compared(spark, folder).where(F.col("base_mean").isNotNull() & F.col("mean").isNotNull()).select(
        F.col("load").alias("release_id"), "column_name", F.round("mean", 6).alias("mean"), F.round("base_mean", 6).alias("base_mean"),
        F.round(F.when(pooled > 0, (F.col("mean") - F.col("base_mean")) / pooled), 6).alias("standardised_difference"),
    )


_LONG_SQL = """
WITH v AS (SELECT release_id r, 'taxa_alfabetizacao' c, taxa_alfabetizacao x, 100 hi, 5 ms FROM silver_municipio
UNION ALL SELECT release_id, 'media_portugues', media_portugues, 1000, 25 FROM silver_municipio),
s AS (SELECT r, c, any_value(ms) ms, count(*) n, count(x) k, count(*) FILTER (x < 0 OR x > hi) o, count(*) FILTER (x <> round(x, 2)) q,
  avg(CAST(x AS DOUBLE)) m, stddev_pop(CAST(x AS DOUBLE)) sd FROM v GROUP BY 1, 2),
tp AS (SELECT r, c, max(n) t FROM (SELECT r, c, x, count(*) n FROM v WHERE x IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2),
b AS (SELECT release_id r, max(trim(baseline_release_id)) b FROM release_registry GROUP BY 1),
j AS (SELECT s.*, t, w.m bm, w.sd bsd FROM s LEFT JOIN tp USING (r, c) LEFT JOIN b USING (r) LEFT JOIN s w ON w.r = b.b AND w.c = s.c)
"""
_MEASURES = ["taxa_alfabetizacao", "media_portugues", *[f"proporcao_aluno_nivel_{k}" for k in range(9)], "ano"]
_TEXTS = ["id_municipio", "serie", "rede", "source_run_id", "ingested_at", "ano_particao"]


def _profile_sql(column: str, numeric: bool) -> str:
    value = f"CAST({column} AS DECIMAL(28,9))" if numeric else (f"CAST(make_timestamp(epoch_us({column})) AS VARCHAR)" if column == "ingested_at" else f"CAST({column} AS VARCHAR)")
    breaks = {"id_municipio": "NOT regexp_full_match(x, '[0-9]{7}')", "taxa_alfabetizacao": "x <> round(x, 2)", "media_portugues": "x <> round(x, 2)"}.get(column, "false")
    return f"""SELECT release_id, '{column}' AS column_name, count(*) AS n_rows, count(*) - count(x) AS n_null, count(DISTINCT x) AS n_distinct,
CAST(min(x) AS VARCHAR) AS min_value, CAST(max(x) AS VARCHAR) AS max_value, count(*) FILTER ({breaks}) AS n_pattern
FROM (SELECT release_id, {value} x FROM silver_municipio) GROUP BY 1"""


P7_SQL = {
    "p7_found": _LONG_SQL + """
SELECT r AS release_id, c AS column_name, 'null_rate' AS finding FROM j WHERE (n - k) * 10 > n
UNION ALL SELECT r, c, 'range' FROM j WHERE o > 0 UNION ALL SELECT r, c, 'decimals' FROM j WHERE q > 0
UNION ALL SELECT r, c, 'top_value' FROM j WHERE t * 5 > k UNION ALL SELECT r, c, 'mean_shift' FROM j WHERE abs(m - bm) > ms
UNION ALL SELECT r, c, 'spread_shift' FROM j WHERE sd > 1.5 * bsd OR sd * 1.5 < bsd""",
    "p7_shifts": _LONG_SQL + """
SELECT r AS release_id, c AS column_name, round(m, 6) AS mean, round(bm, 6) AS base_mean,
  round(CASE WHEN sd + bsd > 0 THEN (m - bm) / sqrt((sd * sd + bsd * bsd) / 2) END, 6) AS standardised_difference FROM j WHERE m IS NOT NULL AND bm IS NOT NULL""",
    "p7_profile": " UNION ALL ".join([_profile_sql(c, True) for c in _MEASURES] + [_profile_sql(c, False) for c in _TEXTS]),
}

QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_corrections, p1_daily, p1_revisions, p2_found, p2_fused, p2_alternatives, p2_hashes, p2_table, p2_wide, p3_found, p3_current, p3_batches, p4_found, p4_hierarchy,
        p4_descendants, p5_found, p5_pending, p5_snapshots, p6_found, p6_once, p7_found, p7_profile, p7_shifts,
    )
}
ORACLES = P1_SQL | P2_SQL | P3_SQL | P4_SQL | P5_SQL | P6_SQL | P7_SQL
