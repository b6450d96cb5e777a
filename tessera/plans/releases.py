"""Queries of the medallion models and the quality gate, and the SQL they are checked with.

The test folders have three of the six silver tables. The other three sources are read from the landed
records: of each source and year those of the run that was completed last, as files of the active
release.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tessera.functions.columns import instant, trimmed
from tessera.operators import gate, hierarchy, lineage, medallion, relational, schema_drift
from tessera.operators.medallion import LEVEL_NAMES, TABLES, TARGET_NAMES
from tessera.plans.catalogue import EVENT, EVENT_ORDER, table, transport_latest
from tessera.session import cut
from tessera.sources.bronze import latest_completed
from tessera.sources.contracts import contract

QUERIES, ORACLES = {}, {}
AS_OF = "2026-01-01"
STORED = {"municipio": "silver_municipio", "uf": "silver_uf", "meta_municipio": "silver_meta_alfabetizacao_municipio"}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return register


# tables ----------------------------------------------------------------------------------------


def pointer(spark, folder):
    """The active pointer: release and moment of promotion."""
    return table(spark, folder, "release_registry").where("status = 'active'").select("release_id", "promoted_at").distinct()


def selected_runs(spark, folder):
    """(run_id, source, row_count, verified_at, ingested_at) of the runs the active release is made of."""
    manifest = table(spark, folder, "batch_manifest")
    runs = latest_completed(manifest).select("run_id", "source")
    done = manifest.where("status = 'completed' AND completed_at IS NOT NULL").groupBy("run_id").agg(
        F.max("row_count").alias("row_count"), F.max("verified_at").alias("verified_at"), F.max("completed_at").alias("ingested_at")
    )
    return runs.join(done, "run_id")


def release_files(spark, folder):
    active = relational.only_if_single(pointer(spark, folder)).select("release_id")
    chosen = selected_runs(spark, folder).select(F.col("source").alias("table_name"), F.lit("selected").alias("status"), "row_count", "verified_at")
    return chosen.join(F.broadcast(active), F.lit(True))  # a constant condition on one row


def landed(spark, folder, name):
    """The records of a source that the active release selects, in the contract's columns."""
    active = relational.only_if_single(pointer(spark, folder)).select("release_id")
    runs = selected_runs(spark, folder).where(F.col("source") == TABLES[name]).select("run_id", "ingested_at")
    records = schema_drift.with_fields(table(spark, folder, "landing_record").join(relational.small_side(runs), "run_id")).where(F.col("has_").isNotNull())
    columns = [F.element_at("has_", c).alias(c) for c, _ in contract(TABLES[name]).columns]
    return records.join(F.broadcast(active), F.lit(True)).select("release_id", F.col("run_id").alias("source_run_id"), "ingested_at", *columns)


def staged(spark, folder, name):
    return medallion.stage(table(spark, folder, STORED[name]) if name in STORED else landed(spark, folder, name), name)


def silver(spark, folder, name):
    return medallion.silver(staged(spark, folder, name), name)


def directory(spark, folder):
    return medallion.current_directory(table(spark, folder, "diretorio_municipio"))


def indicator(spark, folder):
    return medallion.indicators(silver(spark, folder, "municipio"), directory(spark, folder))


def compared(spark, folder):
    tables = {name: silver(spark, folder, name) for name in ("meta_municipio", "meta_uf", "meta_brasil", "uf")}
    return medallion.comparison(tables, indicator(spark, folder), directory(spark, folder))


# SQL of the tables -----------------------------------------------------------------------------

_WHOLE = "CASE WHEN regexp_full_match(trim(CAST({0} AS VARCHAR)), '[+-]?[0-9]+') THEN TRY_CAST(trim(CAST({0} AS VARCHAR)) AS BIGINT) END"
_CODES = {
    "assessment_result": "CASE WHEN r IN ('0', 'total') THEN 'total' WHEN r IN ('2', 'estadual') THEN 'estadual' WHEN r IN ('3', 'municipal') THEN 'municipal' WHEN r IN ('5', 'publica', 'pública') THEN 'publica' END",
    "student_dependency": "CASE WHEN r IN ('1', 'federal') THEN 'federal' WHEN r IN ('2', 'estadual') THEN 'estadual' WHEN r IN ('3', 'municipal') THEN 'municipal' WHEN r IN ('4', 'privada') THEN 'privada' END",
    "target": "CASE WHEN r IN ('total', 'federal', 'estadual', 'municipal', 'privada', 'publica') THEN r WHEN r = 'pública' THEN 'publica' END",
}
_SQL_COLUMNS = {
    "id_municipio": "CASE WHEN regexp_full_match(trim(id_municipio), '[0-9]{1,7}') THEN lpad(trim(id_municipio), 7, '0') END",
    "sigla_uf": "nullif(upper(trim(sigla_uf)), '')", "id_escola": "nullif(trim(id_escola), '')", "id_aluno": "nullif(trim(id_aluno), '')",
}


def _staged_sql(name: str) -> str:
    source = contract(TABLES[name])
    columns = []
    for c, kind in source.columns:
        if c == "rede":
            sql = _CODES[medallion.DOMAINS.get(name, "target")].replace("WHEN r ", "WHEN lower(trim(rede)) ").replace("THEN r ", "THEN lower(trim(rede)) ")
        elif c in _SQL_COLUMNS:
            sql = _SQL_COLUMNS[c]
        else:
            sql = f"trim({c})" if kind == "STRING" else _WHOLE.format(c) if kind == "INT64" else f"TRY_CAST(CAST({c} AS VARCHAR) AS DECIMAL(28,9))"
        columns.append(f"{sql} AS {c}")
    origin = f"{STORED[name]}" if name in STORED else f"land_{name}"
    inner = f"SELECT release_id, source_run_id, ingested_at, {', '.join(columns)} FROM {origin}"
    return f"SELECT *, CASE WHEN ano BETWEEN 1 AND 9999 THEN make_date(CAST(ano AS INT), 1, 1) END AS ano_particao FROM ({inner})"


def _silver_sql(name: str) -> str:
    source = contract(TABLES[name])
    pack = ", ".join(f"{c} := {c}" for c in source.payload)
    return f"""SELECT * EXCLUDE (h, mi, ma, k) FROM (SELECT *, min(h) OVER w mi, max(h) OVER w ma, row_number() OVER (w ORDER BY ingested_at DESC NULLS LAST, source_run_id DESC NULLS LAST) k
FROM (SELECT *, to_json(struct_pack({pack})) h FROM st_{name}) WINDOW w AS (PARTITION BY release_id, {', '.join(source.key)})) WHERE mi = ma AND k = 1"""


_LANDED = {c for name in TABLES if name not in STORED for c, _ in contract(TABLES[name]).columns}
_LAND_SQL = f"""act AS (SELECT max(release_id) release_id, max(promoted_at) promoted_at FROM (SELECT DISTINCT release_id, promoted_at FROM release_registry WHERE status = 'active') HAVING count(*) = 1),
done AS (SELECT run_id, max(row_count) row_count, max(verified_at) verified_at, max(completed_at) ingested_at FROM batch_manifest WHERE status = 'completed' AND completed_at IS NOT NULL GROUP BY 1),
runs AS (SELECT source, run_id, row_count, verified_at, ingested_at FROM (SELECT source, year, arg_max(run_id, (completed_at, run_id)) run_id FROM batch_manifest WHERE status = 'completed' AND completed_at IS NOT NULL GROUP BY 1, 2) JOIN done USING (run_id)),
files AS (SELECT act.release_id, source table_name, row_count, verified_at FROM runs, act),
obj AS (SELECT row_number() OVER () rid, source, run_id, ingested_at, CASE WHEN json_valid(payload) THEN CASE WHEN json_type(payload) = 'OBJECT' THEN payload END END doc FROM landing_record JOIN runs USING (run_id)),
kv AS (SELECT rid, lower(trim(key)) f, arg_max(CASE WHEN type = 'DOUBLE' THEN regexp_replace(value ->> '$', '[.]?0+$', '') ELSE value ->> '$' END, id) v FROM obj, json_each(coalesce(obj.doc, '{{}}')) GROUP BY 1, 2),
pv AS (SELECT rid, {', '.join(f"max(v) FILTER (f = '{c}') {c}" for c in sorted(_LANDED))} FROM kv GROUP BY 1),
{', '.join(f"land_{n} AS (SELECT act.release_id, run_id source_run_id, ingested_at, pv.* FROM obj JOIN pv USING (rid), act WHERE doc IS NOT NULL AND source = '{TABLES[n]}')" for n in TABLES if n not in STORED)}"""
_TABLES_SQL = _LAND_SQL + ", " + ", ".join(f"st_{n} AS ({_staged_sql(n)}), si_{n} AS ({_silver_sql(n)})" for n in TABLES)
_DIR_SQL = "dir AS (SELECT id_municipio, max(nome) AS nome_municipio, max(sigla_uf) AS sigla_uf FROM diretorio_municipio WHERE excluido_em IS NULL GROUP BY 1)"
_LEVELS = ", ".join(LEVEL_NAMES)
_IND_SQL = f"ind AS (SELECT release_id, ano, ano_particao, id_municipio, nome_municipio, sigla_uf, rede, taxa_alfabetizacao, media_portugues, {_LEVELS} FROM si_municipio JOIN dir USING (id_municipio))"
_COMPARED_SQL = f"""tb AS (SELECT release_id, 'municipio' nivel_geografico, id_municipio id_geografia, nome_municipio nome_geografia, rede, ano ano_referencia, {', '.join(TARGET_NAMES)} FROM si_meta_municipio JOIN dir USING (id_municipio) WHERE rede = 'municipal'
UNION ALL SELECT release_id, 'uf', sigla_uf, sigla_uf, rede, ano, {', '.join(TARGET_NAMES)} FROM si_meta_uf WHERE rede = 'publica' UNION ALL SELECT release_id, 'brasil', 'BRASIL', 'Brasil', rede, ano, {', '.join(TARGET_NAMES)} FROM si_meta_brasil WHERE rede = 'publica'),
tl AS (SELECT * EXCLUDE (nm), CAST(right(nm, 4) AS BIGINT) ano_meta FROM tb UNPIVOT (meta_alfabetizacao FOR nm IN ({', '.join(TARGET_NAMES)}))),
tc AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY release_id, ano_meta, nivel_geografico, id_geografia, rede ORDER BY ano_referencia DESC) k FROM tl WHERE ano_referencia <= ano_meta) WHERE k = 1),
rs AS (SELECT release_id, ano, 'municipio' nivel_geografico, id_municipio id_geografia, rede, taxa_alfabetizacao FROM ind WHERE rede = 'municipal' UNION ALL SELECT release_id, ano, 'uf', sigla_uf, rede, taxa_alfabetizacao FROM si_uf WHERE rede = 'publica'
UNION ALL SELECT release_id, ano, 'brasil', 'BRASIL', rede, taxa_alfabetizacao FROM si_meta_brasil WHERE rede = 'publica'),
cmp AS (SELECT t.release_id, ano_meta, r.ano AS ano_resultado, make_date(CAST(ano_meta AS INT), 1, 1) AS ano_particao, t.nivel_geografico, t.id_geografia, nome_geografia, t.rede, ano_referencia, meta_alfabetizacao, r.taxa_alfabetizacao AS taxa_resultado,
  CAST(r.taxa_alfabetizacao - meta_alfabetizacao AS DECIMAL(29,9)) AS gap_pp, CASE WHEN r.taxa_alfabetizacao >= meta_alfabetizacao THEN 'atingida' WHEN r.taxa_alfabetizacao < meta_alfabetizacao THEN 'nao_atingida' END AS status_meta
  FROM tc t LEFT JOIN rs r ON r.release_id = t.release_id AND r.ano = ano_meta AND r.nivel_geografico = t.nivel_geografico AND r.id_geografia = t.id_geografia AND r.rede = t.rede)"""
_GOLD_SQL = f"{_TABLES_SQL}, {_DIR_SQL}, {_IND_SQL}, {_COMPARED_SQL}"


def _plain(rows, name):
    """Rows as they are shown: times as text, pupils under a digest, copies counted."""
    shown = rows.withColumn("ingested_at", F.col("ingested_at").cast("string"))
    if name == "alunos":
        shown = shown.withColumn("id_aluno", F.md5("id_aluno"))
    return shown.groupBy(*shown.columns).agg(F.count(F.lit(1)).alias("n"))


def _text(moment: str) -> str:
    return f"CAST(make_timestamp(epoch_us({moment})) AS VARCHAR)"


def _plain_sql(source, name):
    return f"WITH {_TABLES_SQL} SELECT * REPLACE ({_text('ingested_at')} AS ingested_at{', md5(id_aluno) AS id_aluno' if name == 'alunos' else ''}), count(*) AS n FROM {source}_{name} GROUP BY ALL"


def _register_tables():
    for name in TABLES:
        for stage, make, short in (("staging", staged, "st"), ("silver", silver, "si")):
            QUERIES[f"{stage}_{name}"] = lambda spark, folder, make=make, name=name: _plain(make(spark, folder, name), name)
            ORACLES[f"{stage}_{name}"] = _plain_sql(short, name)


_register_tables()


@query(f"WITH {_LAND_SQL} SELECT release_id, table_name, 'selected' AS status, row_count, {_text('verified_at')} AS verified_at FROM files")
def release_mapping(spark, folder):
    """The files selected for the active release."""
    return release_files(spark, folder).withColumn("verified_at", F.col("verified_at").cast("string"))


# gold ------------------------------------------------------------------------------------------


@query(f"WITH {_GOLD_SQL} SELECT * FROM ind")
def indicador_municipio(spark, folder):
    return indicator(spark, folder)


@query(f"WITH {_GOLD_SQL} SELECT release_id, id_municipio, rede, ano, taxa_alfabetizacao FROM ind QUALIFY row_number() OVER (PARTITION BY release_id, id_municipio, rede ORDER BY ano DESC) = 1")
def latest_year(spark, folder):
    """Of each municipality and network of a release the latest year."""
    return relational.latest(indicator(spark, folder), ["release_id", "id_municipio", "rede"], ["ano"], ["ano", "taxa_alfabetizacao"])


@query(f"""WITH {_TABLES_SQL} SELECT ano_particao, rede, count(*) AS n FROM si_municipio WHERE release_id = (SELECT release_id FROM act) AND ano_particao IN (DATE '2024-01-01', DATE '2025-01-01') GROUP BY ALL""")
def release_partition(spark, folder):
    """One release and the partitions that are to be replaced; both reach the scan."""
    active = relational.only_if_single(pointer(spark, folder)).first()
    rows = table(spark, folder, "silver_municipio").where(
        (F.col("release_id") == F.lit(active["release_id"] if active else None)) & F.col("ano_particao").isin(datetime.date(2024, 1, 1), datetime.date(2025, 1, 1))
    )
    return medallion.silver(medallion.stage(rows, "municipio"), "municipio").groupBy("ano_particao", "rede").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_GOLD_SQL} SELECT * FROM cmp")
def comparativo_meta_resultado(spark, folder):
    """Targets beside results for municipalities, states and the country."""
    return compared(spark, folder)


_SETTLED_SQL = """tr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY message_id, om ORDER BY ingestion_time DESC NULLS LAST, publish_time DESC, et DESC, eid DESC NULLS LAST, delivery_id DESC) tk
  FROM (SELECT *, epoch_us(CAST(event_time AS TIMESTAMPTZ)) et, lower(event_id) eid, CASE WHEN message_id IS NULL THEN delivery_id END om, CASE WHEN event_id IS NULL THEN delivery_id END oe FROM municipal_rate_stream)) WHERE tk = 1),
lg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY eid, oe ORDER BY et DESC, publish_time DESC, ingestion_time DESC NULLS LAST, message_id DESC NULLS LAST, delivery_id DESC) g FROM tr) WHERE g = 1)"""


@query(f"""WITH {_GOLD_SQL}, {_SETTLED_SQL}, lote AS (SELECT ind.* FROM ind JOIN act USING (release_id) QUALIFY row_number() OVER (PARTITION BY id_municipio, rede ORDER BY ano DESC) = 1),
ov AS (SELECT lg.* FROM lg JOIN act ON make_timestamp(et) > make_timestamp(epoch_us(act.promoted_at)) WHERE simulation QUALIFY row_number() OVER (PARTITION BY ano, id_municipio, rede ORDER BY et DESC, publish_time DESC, coalesce(eid, 'row ' || delivery_id) DESC) = 1)
SELECT lote.release_id, ov.correlation_id, lote.ano, ano_particao, lote.id_municipio, nome_municipio, sigla_uf, lote.rede, ov.taxa_participacao AS percentual_participacao, CAST(make_timestamp(ov.et) AS VARCHAR) AS atualizado_em,
coalesce(ov.taxa_alfabetizacao, lote.taxa_alfabetizacao) AS taxa_alfabetizacao, CASE WHEN ov.delivery_id IS NULL THEN 'batch_oficial' ELSE 'stream_simulacao' END AS origem
FROM lote LEFT JOIN ov ON ov.ano = lote.ano AND ov.id_municipio = lote.id_municipio AND ov.rede = lote.rede""")
def indicador_atual_hibrido(spark, folder):
    """The active release's indicators, overlaid by the stream's events after its promotion. An event
    without id is named by its delivery, so that it counts as one."""
    rows = relational.latest(transport_latest(spark, folder), EVENT, EVENT_ORDER)
    events = rows.select(
        F.coalesce("eid", F.concat(F.lit("row "), F.col("delivery_id").cast("string"))).alias("event_id"), instant(F.col("event_time")).alias("event_time"), "publish_time", "ano", "id_municipio", "rede",
        "taxa_alfabetizacao", "taxa_participacao", "correlation_id", "simulation",
    )
    return medallion.hybrid(indicator(spark, folder), pointer(spark, folder), events).withColumn("atualizado_em", F.col("atualizado_em").cast("string"))


# ancestry --------------------------------------------------------------------------------------

_CHAIN_SQL = """rg AS (SELECT release_id i, max(trim(baseline_release_id)) b, max(reference_year) y FROM release_registry GROUP BY 1),
ch AS (SELECT i, b, y, 0 k FROM rg WHERE i = (SELECT release_id FROM act) UNION ALL SELECT rg.i, rg.b, rg.y, ch.k + 1 FROM ch JOIN rg ON rg.i = ch.b),
nr AS (SELECT y, arg_min(i, k) i, min(k) k FROM ch GROUP BY 1)"""


def published(spark, folder):
    """The active release, and of its ancestry the release nearest to it for each reference year."""
    active = relational.only_if_single(pointer(spark, folder)).first()  # one row
    root = active["release_id"] if active else None
    return root, cut(lineage.nearest_per_year(lineage.chain(table(spark, folder, "release_registry"), root)), "published")


def evolved(spark, folder):
    root, steps = published(spark, folder)
    return medallion.evolution(indicator(spark, folder), steps, root), steps


_EVO_SQL = """ev AS (SELECT *, lag(taxa_alfabetizacao) OVER (PARTITION BY id_municipio, rede ORDER BY ano, release_id) AS taxa_ano_anterior FROM ind WHERE release_id IN (SELECT i FROM nr)),
evo AS (SELECT *, CAST(taxa_alfabetizacao - taxa_ano_anterior AS DECIMAL(29,9)) AS variacao_pp FROM ev WHERE release_id = (SELECT release_id FROM act))"""


@query(f"WITH RECURSIVE {_GOLD_SQL}, {_CHAIN_SQL}, {_EVO_SQL} SELECT * FROM evo")
def evolucao_alfabetizacao(spark, folder):
    """The active release's rates beside those of the year before that there is in its ancestry."""
    return evolved(spark, folder)[0]


@query(f"WITH RECURSIVE {_GOLD_SQL}, {_CHAIN_SQL} SELECT ind.* FROM ind JOIN nr ON nr.i = ind.release_id")
def public_indicador_municipio(spark, folder):
    _, steps = published(spark, folder)
    return indicator(spark, folder).join(relational.small_side(steps.select("release_id")), "release_id")


@query(f"WITH RECURSIVE {_GOLD_SQL}, {_CHAIN_SQL}, {_EVO_SQL} SELECT evo.* FROM evo JOIN nr ON nr.i = evo.release_id")
def public_evolucao_alfabetizacao(spark, folder):
    rows, steps = evolved(spark, folder)
    return rows.join(relational.small_side(steps.select("release_id")), "release_id")


@query(f"""WITH RECURSIVE {_GOLD_SQL}, {_CHAIN_SQL} SELECT cmp.* FROM cmp JOIN nr ON nr.i = cmp.release_id WHERE nr.y <= ano_meta
QUALIFY row_number() OVER (PARTITION BY ano_meta, nivel_geografico, id_geografia, rede ORDER BY nr.y DESC, nr.k) = 1""")
def public_comparativo_meta_resultado(spark, folder):
    _, steps = published(spark, folder)
    return medallion.published_comparison(compared(spark, folder), steps)


@query(f"WITH RECURSIVE {_LAND_SQL}, {_CHAIN_SQL} SELECT a.i AS release_id, b.i AS baseline FROM ch a JOIN ch b ON b.k = a.k + 1 WHERE a.y < b.y")
def chain_year_order(spark, folder):
    """Steps of the active ancestry at which the reference year falls: a self-join of the chain."""
    active = relational.only_if_single(pointer(spark, folder)).first()
    steps = cut(lineage.chain(table(spark, folder, "release_registry"), active["release_id"] if active else None), "chain")
    up = steps.select(F.col("release_id").alias("baseline"), F.col("reference_year").alias("base_year"), (F.col("chain_level") - 1).alias("chain_level"))
    return steps.join(up, "chain_level").where(F.col("reference_year") < F.col("base_year")).select("release_id", "baseline")


@query("""WITH RECURSIVE r AS (SELECT release_id i, max(trim(baseline_release_id)) b, max(reference_year) y FROM release_registry GROUP BY 1),
t AS (SELECT i, [i] p FROM r WHERE b IS NULL OR b NOT IN (SELECT i FROM r) UNION ALL SELECT r.i, list_prepend(r.i, t.p) FROM r JOIN t ON r.b = t.i),
c AS (SELECT p FROM t WHERE i = (SELECT arg_max(release_id, (completed_at, release_id)) FROM release_registry WHERE status = 'succeeded' AND completed_at IS NOT NULL AND release_id IN (SELECT i FROM t WHERE len(p) > 1))),
u AS (SELECT unnest(p) i, unnest(range(len(p))) k FROM c) SELECT i AS release_id, y AS reference_year, k AS chain_level FROM u JOIN r USING (i)""")
def candidate_chain(spark, folder):
    """The ancestry of the candidate that was completed last, of those built on another release."""
    registry = table(spark, folder, "release_registry")
    built = hierarchy.hierarchy(registry, "release_id", "baseline_release_id", with_path=False).where("depth > 0").select(F.col("node").alias("release_id"))
    done = registry.where("status = 'succeeded' AND completed_at IS NOT NULL").join(built, "release_id", "left_semi")
    last = done.agg(F.max_by("release_id", F.struct("completed_at", "release_id"))).first()[0]
    return lineage.chain(registry, last).select("release_id", "reference_year", "chain_level")


@query("""WITH RECURSIVE r AS (SELECT release_id i, max(trim(baseline_release_id)) b, max(reference_year) y FROM release_registry GROUP BY 1),
c AS (SELECT i, b, y, 0 k, '|' || i || '|' p FROM r WHERE i = (SELECT max(release_id) FROM release_registry WHERE status = 'active')
UNION ALL SELECT r.i, r.b, r.y, c.k + 1, c.p || r.i || '|' FROM c JOIN r ON r.i = c.b WHERE c.k < 400)
SELECT i AS release_id, y AS reference_year, CAST(k AS BIGINT) AS chain_level, p AS release_path, false AS has_cycle FROM c""")
def rollback_lineage(spark, folder):
    """What the active release can be rolled back to, with the path to it, 400 levels at most."""
    active = relational.only_if_single(pointer(spark, folder)).first()
    return lineage.rollback_lineage(table(spark, folder, "release_registry"), active["release_id"] if active else None)


@query(f"""WITH RECURSIVE rg AS (SELECT release_id i, max(trim(baseline_release_id)) b FROM release_registry GROUP BY 1), a AS (SELECT max(release_id) r FROM release_registry WHERE status = 'active'),
p AS (SELECT i, b FROM rg WHERE i IN (SELECT r FROM a) OR i IN (SELECT b FROM rg JOIN a ON rg.i = a.r) UNION SELECT rg.i, rg.b FROM p JOIN rg ON rg.i = p.b)
SELECT DISTINCT release_id FROM release_registry WHERE release_id NOT IN (SELECT i FROM p)
AND ((status = 'failed' AND created_at < TIMESTAMPTZ '{AS_OF} 00:00:00+00' - INTERVAL 7 DAY) OR (status = 'succeeded' AND created_at < TIMESTAMPTZ '{AS_OF} 00:00:00+00' - INTERVAL 30 DAY))""")
def cleanup_candidates(spark, folder):
    """Releases to clean up: old, never promoted, and in the ancestry of neither the active nor the prior release."""
    registry = table(spark, folder, "release_registry")
    active = relational.only_if_single(pointer(spark, folder)).select("release_id")
    prior = registry.join(active, "release_id").select(trimmed(F.col("baseline_release_id")).alias("release_id"))
    return lineage.expired(registry, lineage.protected(registry, active.unionByName(prior)), AS_OF)


@query(f"""WITH a AS (SELECT max(release_id) r FROM (SELECT DISTINCT release_id FROM release_registry WHERE status = 'active') HAVING count(*) = 1)
SELECT release_id, status, {_text('created_at')} AS created_at, {_text('completed_at')} AS completed_at, release_id = a.r AS is_active FROM release_registry, a""")
def release_health(spark, folder):
    """Every registry row beside the pointer: a cross join with its one row."""
    active = relational.only_if_single(pointer(spark, folder).select(F.col("release_id").alias("active_id")).distinct())
    rows = table(spark, folder, "release_registry").crossJoin(F.broadcast(active))  # one row
    moments = [F.col(c).cast("string").alias(c) for c in ("created_at", "completed_at")]
    return rows.select("release_id", "status", *moments, (F.col("release_id") == F.col("active_id")).alias("is_active"))


# quality ---------------------------------------------------------------------------------------


def gate_inputs(spark, folder):
    # landed records are parsed once; the stored tables' projection is not worth a table of its own
    st = {name: rows if name in STORED else cut(rows, f"staged-{name}") for name, rows in ((n, staged(spark, folder, n)) for n in TABLES)}
    si = {name: cut(medallion.silver(rows, name), f"silver-{name}") for name, rows in st.items()}
    names = directory(spark, folder)
    flat = medallion.indicators(si["municipio"], names)
    registry = table(spark, folder, "release_registry").groupBy("release_id").agg(
        F.max(trimmed(F.col("baseline_release_id"))).alias("baseline_release_id"), F.max("reference_year").alias("reference_year")
    )
    ids = relational.union_all([st[n].select("release_id") for n in TABLES]).where(F.col("release_id").isNotNull()).distinct()
    return gate.Inputs(
        st, si, table(spark, folder, "diretorio_municipio"), release_files(spark, folder), cut(ids.join(registry, "release_id", "left"), "releases"), flat,
        medallion.comparison(si, flat, names),
    )


@query(f"WITH {_TABLES_SQL} SELECT release_id, ano, sigla_uf, rede, source_run_id, reason_code, count(*) AS n FROM (SELECT *, CASE WHEN taxa_alfabetizacao IS NULL AND percentual_participacao IS NULL THEN 'taxa_alfabetizacao_and_percentual_participacao_missing' WHEN taxa_alfabetizacao IS NULL THEN 'taxa_alfabetizacao_missing' WHEN percentual_participacao IS NULL THEN 'percentual_participacao_missing' END reason_code FROM st_meta_uf) WHERE reason_code IS NOT NULL GROUP BY ALL")
def reject_routing(spark, folder):
    """State targets without rate or participation, with the reason, before any deduplication."""
    rows = medallion.target_rejections(staged(spark, folder, "meta_uf")).drop("ingested_at")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


def _pack(columns):
    return f"to_json(struct_pack({', '.join(f'{c} := {c}' for c in columns)}))"


_CANDIDATES_SQL = "cand AS (" + " UNION ALL ".join(
    f"SELECT release_id, '{n}' table_name, source_run_id, ingested_at, {_pack(contract(TABLES[n]).key)} bk, {_pack(contract(TABLES[n]).payload)} rh FROM st_{n}" for n in TABLES
) + """), ck AS (SELECT release_id, table_name, bk, count(*) copies, count(DISTINCT rh) variants, count(DISTINCT coalesce(source_run_id, '')) runs FROM cand GROUP BY 1, 2, 3 HAVING count(*) > 1)"""


@query(f"""WITH {_TABLES_SQL}, {_CANDIDATES_SQL} SELECT release_id, table_name, CASE WHEN variants = 1 THEN 'identical' ELSE 'conflicting' END AS kind, count(*) AS n_keys, CAST(sum(copies) AS BIGINT) AS n_rows FROM ck GROUP BY ALL""")
def duplicate_audit(spark, folder):
    """Keys of the six tables that are stored more than once, by whether their copies agree."""
    keys = medallion.duplicate_keys(medallion.duplicate_candidates({n: staged(spark, folder, n) for n in TABLES}))
    once = keys.select("release_id", "table_name", "business_key_hash", "copies", "kind").distinct()
    return once.groupBy("release_id", "table_name", "kind").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("copies").alias("n_rows"))


_IDS_SQL = "ids AS (SELECT release_id r, any_value(b) b, any_value(y) y FROM (" + " UNION ".join(f"SELECT release_id FROM st_{n}" for n in TABLES) + """)
LEFT JOIN (SELECT release_id, max(trim(baseline_release_id)) b, max(reference_year) y FROM release_registry GROUP BY 1) USING (release_id) WHERE release_id IS NOT NULL GROUP BY 1)"""


def _relation_sql(k, child, parent, on, where="true"):
    keys = on.split(", ")
    same = " AND ".join(f"p.{c} = c.{c}" for c in keys)
    return f"SELECT c.release_id, '{gate.RELATIONS[k]}' relation_name, count(*) checked, count(*) FILTER (p.{keys[-1]} IS NULL) missing FROM {child} c LEFT JOIN (SELECT DISTINCT {on} FROM {parent}) p ON {same} WHERE {where} GROUP BY 1"


_RELATIONS_SQL = f"""ut AS (SELECT release_id, CAST(right(nm, 4) AS BIGINT) ano, sigla_uf, rede FROM (SELECT release_id, ano a, sigla_uf, rede, {', '.join(TARGET_NAMES)} FROM si_meta_uf WHERE rede = 'publica') UNPIVOT (m FOR nm IN ({', '.join(TARGET_NAMES)})) WHERE a <= CAST(right(nm, 4) AS BIGINT)),
found AS ({' UNION ALL '.join([
    _relation_sql(0, 'si_alunos', 'diretorio_municipio', 'id_municipio'), _relation_sql(1, 'si_municipio', 'diretorio_municipio', 'id_municipio'),
    _relation_sql(2, 'si_uf', 'diretorio_municipio', 'sigla_uf'), _relation_sql(3, 'si_meta_municipio', 'diretorio_municipio', 'id_municipio'),
    _relation_sql(4, 'si_meta_uf', 'diretorio_municipio', 'sigla_uf'), _relation_sql(5, 'si_meta_municipio', 'si_municipio', 'release_id, ano, id_municipio, rede', "c.rede = 'municipal'"),
    _relation_sql(6, 'si_uf', 'ut', 'release_id, ano, sigla_uf, rede', "c.rede = 'publica'"),
])}),
rel AS (SELECT r release_id, n relation_name, coalesce(checked, 0) checked_rows, coalesce(missing, 0) missing_rows FROM ids CROSS JOIN (SELECT unnest({list(gate.RELATIONS)}) n) w LEFT JOIN found ON found.release_id = r AND found.relation_name = n)"""


@query(f"WITH {_TABLES_SQL}, {_IDS_SQL}, {_RELATIONS_SQL} SELECT * FROM rel")
def relationship_checks(spark, folder):
    """The seven relations of each release: references checked and missing."""
    return gate.relationship_measures(gate_inputs(spark, folder))


_NULL_KEY = "ano IS NULL OR g IS NULL OR g = '' OR rede IS NULL OR rede = '' OR (t = 'alunos' AND (x IS NULL OR x = '|'))"
_KEY_ROWS = " UNION ALL ".join(
    f"SELECT '{n}' t, release_id, ano, {chr(39) + 'BRASIL' + chr(39) if n == 'meta_brasil' else 'sigla_uf' if n in ('uf', 'meta_uf') else 'id_municipio'} g, rede, {'id_escola || chr(124) || id_aluno' if n == 'alunos' else 'NULL::VARCHAR'} x FROM si_{n}" for n in TABLES
)
_OUT_RESULT = " OR ".join(f"{c} IS NULL OR {c} NOT BETWEEN 0 AND 100" for c in ["taxa_alfabetizacao", *LEVEL_NAMES])
_OUT_NEEDED = " OR ".join(f"{c} IS NULL OR {c} NOT BETWEEN 0 AND 100" for c in ("taxa_alfabetizacao", "percentual_participacao"))
_OUT_TARGET = " OR ".join(f"coalesce({c} NOT BETWEEN 0 AND 100, false)" for c in TARGET_NAMES)
_NEG_RESULT = " OR ".join(f"coalesce({c} < 0, false)" for c in ["media_portugues", "taxa_alfabetizacao", *LEVEL_NAMES])
_NEG_TARGET = " OR ".join(f"coalesce({c} < 0, false)" for c in ["taxa_alfabetizacao", "percentual_participacao", *TARGET_NAMES])
_BAD_SUM = " OR ".join(f"{c} IS NULL" for c in LEVEL_NAMES) + f" OR abs({' + '.join(LEVEL_NAMES)} - 100) > 0.5"
_GAP = "coalesce(ano = 2024 AND sigla_uf = 'RR' AND rede = 'publica' AND taxa_alfabetizacao IS NULL AND percentual_participacao IS NULL, false)"
_DEFECT_ROWS = " UNION ALL ".join(
    [f"SELECT release_id, {_OUT_RESULT} o, {_NEG_RESULT} g, {_BAD_SUM} p, false w FROM si_{n}" for n in ("municipio", "uf")]
    + [f"SELECT release_id, {_OUT_NEEDED} OR {_OUT_TARGET}, {_NEG_TARGET}, false, {w} FROM si_{n}" for n, w in (("meta_municipio", "false"), ("meta_brasil", "coalesce(rede = 'publica' AND meta_alfabetizacao_2030 BETWEEN 0 AND 100, false)"))]
    + [f"SELECT release_id, (({_OUT_NEEDED}) AND NOT {_GAP}) OR {_OUT_TARGET}, {_NEG_TARGET}, false, false FROM si_meta_uf", "SELECT release_id, false, coalesce(proficiencia < 0, false) OR coalesce(peso_aluno < 0, false), false, false FROM si_alunos"]
)
_BAD_GOLD = "ano IS NULL OR coalesce(id_municipio, '') = '' OR coalesce(rede, '') = '' OR taxa_alfabetizacao IS NULL OR coalesce(nome_municipio, '') = '' OR coalesce(sigla_uf, '') = ''"
_BAD_COMPARED = """ano_meta IS NULL OR coalesce(nivel_geografico, '') = '' OR coalesce(id_geografia, '') = '' OR coalesce(nome_geografia, '') = '' OR coalesce(rede, '') = '' OR ano_referencia IS NULL OR meta_alfabetizacao IS NULL
OR CASE WHEN ano_resultado IS NULL THEN ano_meta <= y OR taxa_resultado IS NOT NULL OR gap_pp IS NOT NULL OR status_meta IS NOT NULL ELSE ano_resultado <> ano_meta OR taxa_resultado IS NULL OR gap_pp IS NULL OR status_meta IS NULL END"""

_GATE_SQL = f"""{_GOLD_SQL}, {_IDS_SQL}, {_RELATIONS_SQL}, {_CANDIDATES_SQL},
kr AS (SELECT *, {_NULL_KEY} b FROM ({_KEY_ROWS})),
m1 AS (SELECT release_id r, count(DISTINCT t) cov, 100.0::DOUBLE * count(*) FILTER (b) / count(*) nr FROM kr GROUP BY 1),
m2 AS (SELECT release_id r, 100.0::DOUBLE * sum(n - 1) / sum(n) dr FROM (SELECT release_id, count(*) n FROM kr GROUP BY t, release_id, ano, g, rede, x) GROUP BY 1),
ft AS (SELECT release_id r, table_name t, sum(row_count) n, max(date_diff('day', CAST(make_timestamp(epoch_us(verified_at)) AS DATE), DATE '{AS_OF}')) d FROM files GROUP BY 1, 2),
m3 AS (SELECT r, count(*) FILTER (t IN {tuple(TABLES.values())}) cs, count(*) FILTER (t IN {tuple(TABLES.values())} AND n > 0) fs, count(*) FILTER (t NOT IN {tuple(TABLES.values())}) us, max(d) dd FROM ft GROUP BY 1),
m4 AS (SELECT release_id r, count(*) FILTER ({_GAP}) rk, count(*) FILTER (NOT {_GAP}) ru FROM st_meta_uf WHERE taxa_alfabetizacao IS NULL OR percentual_participacao IS NULL GROUP BY 1),
m5 AS (SELECT release_id r, sum(checked_rows) ck, sum(missing_rows) ms, count(*) FILTER (checked_rows > 0) fl FROM rel GROUP BY 1),
m6 AS (SELECT release_id r, count(*) gr, count(*) FILTER (b) gb FROM (SELECT release_id, {_BAD_GOLD} b FROM ind UNION ALL SELECT release_id, {_BAD_COMPARED} FROM cmp JOIN ids ON ids.r = release_id) GROUP BY 1),
m7 AS (SELECT release_id r, count(*) FILTER (o) o, count(*) FILTER (g) g, count(*) FILTER (p) p, count(*) FILTER (w) w FROM ({_DEFECT_ROWS}) GROUP BY 1),
m8 AS (SELECT release_id r, 100.0::DOUBLE * sum(n - 1) / sum(n) rr FROM (SELECT release_id, count(*) n FROM st_alunos GROUP BY release_id, ano, id_municipio, id_escola, id_aluno) GROUP BY 1),
m9 AS (SELECT release_id r, sum((copies - 1) * runs) FILTER (variants = 1) ic, count(DISTINCT bk) FILTER (variants > 1) cc FROM ck GROUP BY 1),
vo AS (SELECT release_id r, count(*) n, count(*) FILTER (media_portugues IS NULL) x FROM si_municipio GROUP BY 1),
me AS (SELECT ids.r, coalesce(cov, 0) cov, coalesce(nr, 0) nr, coalesce(dr, 0) dr, coalesce(cs, 0) cs, 6 - coalesce(fs, 0) es, coalesce(us, 0) us, dd, coalesce(rk, 0) rk, coalesce(ru, 0) ru, ck, ms, fl, coalesce(gr, 0) gr, coalesce(gb, 0) gb,
  coalesce(o, 0) + CASE WHEN coalesce(w, 0) = 0 THEN 1 ELSE 0 END o, coalesce(g, 0) g, coalesce(p, 0) p, coalesce(rr, 0) rr, coalesce(ic, 0) ic, coalesce(cc, 0) cc, coalesce(vo.n, 0) tn, coalesce(ba.n, 0) bn,
  100.0::DOUBLE * vo.x / vo.n - 100.0::DOUBLE * ba.x / ba.n nd, 100.0::DOUBLE * (coalesce(vo.n, 0) - ba.n) / ba.n vd
  FROM ids LEFT JOIN m1 USING (r) LEFT JOIN m2 USING (r) LEFT JOIN m3 USING (r) LEFT JOIN m4 USING (r) LEFT JOIN m5 USING (r) LEFT JOIN m6 USING (r) LEFT JOIN m7 USING (r) LEFT JOIN m8 USING (r) LEFT JOIN m9 USING (r) LEFT JOIN vo USING (r) LEFT JOIN vo ba ON ba.r = ids.b),
fl AS (SELECT *, 6 - cs + es + us + 6 - cov gaps, nr <> 0 OR cs <> 6 OR es <> 0 OR us <> 0 OR cov <> 6 OR ru <> 0 OR rk > 1 kb, fl = 7 AND ms = 0 ok FROM me)"""


def _rule_sql(k, metric, severity, action, details):
    return f"SELECT r release_id, '{gate.RULES[k]}' rule_id, CAST({metric} AS DOUBLE) metric_value, {severity} severity, {action} action, {details} details FROM fl"


def _if_sql(test, severity, action):
    return f"CASE WHEN {test} THEN '{severity}' ELSE 'pass' END", f"CASE WHEN {test} THEN '{action}' ELSE 'promote' END"


_RULES_SQL = " UNION ALL ".join([
    _rule_sql(0, "greatest(nr, gaps, ru, rk - 1)", "CASE WHEN kb THEN 'critical' WHEN rk = 1 THEN 'warning' ELSE 'pass' END", "CASE WHEN kb THEN 'quarantine_and_block' WHEN rk = 1 THEN 'continue_with_alert' ELSE 'promote' END",
              "CASE WHEN rk = 1 AND ru = 0 THEN 'six_non_empty_sources_and_silver_required_keys_with_rr_2024_publica_exception' ELSE 'six_non_empty_sources_and_silver_required_keys' END"),
    _rule_sql(1, "dr", *_if_sql("dr <> 0", "critical", "quarantine_and_block"), "'six_silver_business_keys'"),
    _rule_sql(2, "least(coalesce(100.0::DOUBLE * (ck - ms) / nullif(ck, 0), 0), 100.0::DOUBLE * fl / 7)", *_if_sql("NOT ok", "critical", "quarantine_and_block"), "'sete_relacoes_de_referencia'"),
    _rule_sql(3, "100.0::DOUBLE * gb / nullif(gr, 0)", *_if_sql("NOT (gr > 0 AND gb = 0)", "critical", "block_promotion"), "'non_empty_gold_core_and_directory_columns'"),
    _rule_sql(4, "nd", *_if_sql("bn = 0 OR nd > 5", "warning", "continue_with_alert"), "CASE WHEN bn = 0 THEN 'baseline_missing' ELSE 'media_portugues_pp_delta' END"),
    _rule_sql(5, "o", *_if_sql("o <> 0", "critical", "quarantine_and_block"), "'required_rates_participation_optional_targets_brasil_publica_2030_required'"),
    _rule_sql(6, "g", *_if_sql("g <> 0", "critical", "quarantine_and_block"), "'silver_measurements'"),
    _rule_sql(7, "p", *_if_sql("p <> 0", "critical", "quarantine_and_block"), "'municipio_and_uf_sum_99_5_to_100_5'"),
    _rule_sql(8, "rr", "CASE WHEN rr <= 0.01 THEN 'pass' WHEN rr <= 0.50 THEN 'warning' ELSE 'critical' END", "CASE WHEN rr <= 0.01 THEN 'promote' WHEN rr <= 0.50 THEN 'continue_with_alert' ELSE 'quarantine_and_block' END", "'stg_alunos_pre_deduplication'"),
    _rule_sql(9, "abs(vd)", "CASE WHEN bn = 0 THEN 'warning' WHEN tn = 0 OR vd < -50 THEN 'critical' WHEN abs(vd) > 20 THEN 'warning' ELSE 'pass' END",
              "CASE WHEN tn = 0 OR vd < -50 THEN 'block_promotion' WHEN bn = 0 OR abs(vd) > 20 THEN 'continue_with_alert' ELSE 'promote' END", "CASE WHEN bn = 0 THEN 'baseline_missing' ELSE 'silver_municipio_release_total' END"),
    _rule_sql(10, "dd", *_if_sql("NOT coalesce(dd <= 35, false)", "critical", "block_promotion"), "'oldest_selected_source_verification_days'"),
    _rule_sql(11, "ic", *_if_sql("ic <> 0", "warning", "deduplicate_and_alert"), "'audit_identical_duplicates_excess_copies'"),
    _rule_sql(12, "cc", *_if_sql("cc <> 0", "critical", "quarantine_and_block"), "'quarantine_conflicting_business_keys'"),
])


@query(f"WITH {_GATE_SQL} SELECT release_id, rule_id, round(metric_value, 9) AS metric_value, severity, action, details FROM ({_RULES_SQL})")
def release_metrics(spark, folder):
    """The thirteen rules of every release."""
    found = gate.metrics(cut(gate.measure(gate_inputs(spark, folder), AS_OF), "measured"))
    return found.withColumn("metric_value", F.round("metric_value", 9))


# stream counts ---------------------------------------------------------------------------------

_SINCE = "2025-06-01"


@query(f"""SELECT coalesce(correlation_id, '') AS correlation_id, count(DISTINCT lower(event_id)) AS n_events, count(*) AS n_rows FROM municipal_rate_stream
WHERE epoch_us(ingestion_time) >= epoch_us(TIMESTAMPTZ '{_SINCE} 00:00:00+00') GROUP BY 1""")
def count_polls(spark, folder):
    """What a poll waits for: events and rows of each correlation that arrived in the window."""
    rows = table(spark, folder, "municipal_rate_stream").where(F.col("ingestion_time") >= F.lit(_SINCE).cast("timestamp"))
    return rows.groupBy(F.coalesce("correlation_id", F.lit("")).alias("correlation_id")).agg(F.countDistinct(F.lower("event_id")).alias("n_events"), F.count(F.lit(1)).alias("n_rows"))
