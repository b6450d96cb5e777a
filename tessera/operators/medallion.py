"""The medallion models: staging by contract, silver without copies, gold indicators.

Every function takes tables of any number of releases and does all of them at once; a release is a
part of every key, never a loop. Tables are DataFrames by the names of ``TABLES``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import trimmed
from tessera.functions.domain import normalize_municipality_id, normalize_network, payload_hash, rate, year_start
from tessera.operators import relational
from tessera.sources.contracts import LEVELS, TARGETS, contract

#: Name of a table in the models -> its source.
TABLES = {
    "municipio": "municipio", "uf": "uf", "meta_municipio": "meta_alfabetizacao_municipio", "meta_uf": "meta_alfabetizacao_uf",
    "meta_brasil": "meta_alfabetizacao_brasil", "alunos": "alunos",
}
DOMAINS = {"municipio": "assessment_result", "uf": "assessment_result", "alunos": "student_dependency"}
LEVEL_NAMES, TARGET_NAMES = [name for name, _ in LEVELS], [name for name, _ in TARGETS]
ORIGIN = ["release_id", "source_run_id", "ingested_at"]


def whole(value: Column) -> Column:
    """A whole number from whatever type it comes in; null if it is none."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("bigint"))


def stage(rows: DataFrame, name: str) -> DataFrame:
    """The typed projection of a source: the contract's columns, normalised, and where rows come from."""
    source = contract(TABLES[name])
    empty_is_null = lambda c: F.when(c != "", c)
    columns = []
    for column, kind in source.columns:
        value = F.col(column)
        if column == "id_municipio":
            typed = normalize_municipality_id(value)
        elif column == "sigla_uf":
            typed = empty_is_null(F.upper(trimmed(value)))
        elif column == "rede":
            typed = normalize_network(value, DOMAINS.get(name, "target"))
        elif column in ("id_escola", "id_aluno"):
            typed = empty_is_null(trimmed(value))
        elif kind == "STRING":
            typed = trimmed(value)
        else:
            typed = whole(value) if kind == "INT64" else rate(value)
        columns.append(typed.alias(column))
    staged = rows.select(*ORIGIN, *columns)
    return staged.withColumn("ano_particao", F.when(F.col("ano").between(1, 9999), year_start(F.col("ano"))))


def silver(staged: DataFrame, name: str) -> DataFrame:
    """One row for each key of a release; keys with differing payloads are left out."""
    source = contract(TABLES[name])
    return relational.deduplicate(staged, ["release_id", *source.key], source.payload, ["ingested_at", "source_run_id"])


def target_rejections(staged: DataFrame, place: str = "sigla_uf") -> DataFrame:
    """Target rows without rate or participation, before copies are removed, each with the reason."""
    no_rate, no_part = F.col("taxa_alfabetizacao").isNull(), F.col("percentual_participacao").isNull()
    # fixed values: the reason codes
    reason = F.when(no_rate & no_part, "taxa_alfabetizacao_and_percentual_participacao_missing").when(no_rate, "taxa_alfabetizacao_missing")
    return staged.where(no_rate | no_part).select(
        "release_id", "ano", place, "rede", "source_run_id", "ingested_at", reason.otherwise("percentual_participacao_missing").alias("reason_code")
    )


def duplicate_candidates(staged: dict[str, DataFrame]) -> DataFrame:
    """All rows of all tables as (release_id, table_name, source_run_id, ingested_at, business_key_hash, row_hash)."""
    return relational.union_all([
        rows.select(
            "release_id", F.lit(name).alias("table_name"), "source_run_id", "ingested_at",
            payload_hash(*contract(TABLES[name]).key).alias("business_key_hash"), payload_hash(*contract(TABLES[name]).payload).alias("row_hash"),
        )
        for name, rows in staged.items()
    ])


def duplicate_keys(candidates: DataFrame) -> DataFrame:
    """Keys stored more than once: copies, and whether they agree. Counted in two steps, so that a key
    of very many rows is never gathered."""
    key = ["release_id", "table_name", "business_key_hash"]
    by_run = candidates.groupBy(*key, "source_run_id", "row_hash").agg(F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("detected_at"))
    keys = by_run.groupBy(*key).agg(F.sum("n").alias("copies"), F.min("row_hash").alias("a_"), F.max("row_hash").alias("b_"))
    joined = by_run.join(keys.where("copies > 1"), key)
    return joined.withColumn("kind", F.when(F.col("a_") == F.col("b_"), "identical").otherwise("conflicting")).drop("a_", "b_")


def identical_copies(candidates: DataFrame) -> DataFrame:
    """The audit of copies that agree: a row for each key and run; ``copies`` counts those of all runs."""
    rows = duplicate_keys(candidates).where("kind = 'identical'")
    return rows.groupBy("release_id", "table_name", "business_key_hash", "source_run_id").agg(F.max("detected_at").alias("detected_at"), F.max("copies").alias("copies"))


def conflicting_copies(candidates: DataFrame) -> DataFrame:
    """The quarantine of copies that differ: a row for each key and payload."""
    rows = duplicate_keys(candidates).where("kind = 'conflicting'")
    return rows.groupBy("release_id", "table_name", "business_key_hash", "row_hash").agg(F.max("source_run_id").alias("source_run_id"), F.max("detected_at").alias("detected_at"))


def current_directory(directory: DataFrame) -> DataFrame:
    """One row for each municipality that still exists."""
    open_rows = directory.where(F.col("excluido_em").isNull())
    return open_rows.groupBy("id_municipio").agg(F.max("nome").alias("nome_municipio"), F.max("sigla_uf").alias("sigla_uf"))


def indicators(results: DataFrame, directory: DataFrame) -> DataFrame:
    """Municipal results with name and state; results of unknown municipalities have no part in gold."""
    return results.join(relational.small_side(directory), "id_municipio").select(
        "release_id", "ano", "ano_particao", "id_municipio", "nome_municipio", "sigla_uf", "rede", "taxa_alfabetizacao", "media_portugues", *LEVEL_NAMES
    )


def _tagged(rows: DataFrame, level: str, place: Column, network: str, *columns: Column) -> DataFrame:
    return rows.where(F.col("rede") == network).select("release_id", F.lit(level).alias("nivel_geografico"), place.alias("id_geografia"), "rede", *columns)


def chosen_targets(tables: dict[str, DataFrame], directory: DataFrame) -> DataFrame:
    """Of each level, place, network and target year the target of the latest reference year not after
    it; nulls are no targets. Municipal targets are those of the directory's municipalities."""
    named = tables["meta_municipio"].join(relational.small_side(directory), "id_municipio")
    wide = [F.col("ano").alias("ano_referencia"), *[F.col(t) for t in TARGET_NAMES]]
    rows = relational.union_all([
        _tagged(named, "municipio", F.col("id_municipio"), "municipal", F.col("nome_municipio").alias("nome_geografia"), *wide),
        _tagged(tables["meta_uf"], "uf", F.col("sigla_uf"), "publica", F.col("sigla_uf").alias("nome_geografia"), *wide),
        _tagged(tables["meta_brasil"], "brasil", F.lit("BRASIL"), "publica", F.lit("Brasil").alias("nome_geografia"), *wide),
    ])
    place = ["release_id", "nivel_geografico", "id_geografia", "rede"]
    long = relational.unpivot(rows, [*place, "nome_geografia", "ano_referencia"], TARGET_NAMES, "nome_meta", "meta_alfabetizacao")
    long = long.withColumn("ano_meta", F.expr("right(nome_meta, 4)").cast("long"))
    return relational.as_of(long, [*place, "ano_meta"], "ano_referencia", "ano_meta", ["nome_geografia", "meta_alfabetizacao"])


def comparison(tables: dict[str, DataFrame], indicator: DataFrame, directory: DataFrame) -> DataFrame:
    """Targets beside results on three levels; a target whose result is not there yet keeps nulls."""
    result = [F.col("ano").alias("ano_resultado"), F.col("taxa_alfabetizacao").alias("taxa_resultado")]
    results = relational.union_all([
        _tagged(indicator, "municipio", F.col("id_municipio"), "municipal", *result),
        _tagged(tables["uf"], "uf", F.col("sigla_uf"), "publica", *result),
        _tagged(tables["meta_brasil"], "brasil", F.lit("BRASIL"), "publica", *result),
    ])
    keys = ["release_id", "nivel_geografico", "id_geografia", "rede"]
    joined = chosen_targets(tables, directory).join(results.withColumn("ano_meta", F.col("ano_resultado")), [*keys, "ano_meta"], "left")
    gap = F.col("taxa_resultado") - F.col("meta_alfabetizacao")
    return joined.select(
        "release_id", "ano_meta", "ano_resultado", year_start(F.col("ano_meta")).alias("ano_particao"), "nivel_geografico", "id_geografia", "nome_geografia",
        "rede", "ano_referencia", "meta_alfabetizacao", "taxa_resultado", gap.alias("gap_pp"), F.when(gap >= 0, "atingida").when(gap < 0, "nao_atingida").alias("status_meta"),
    )


def evolution(indicator: DataFrame, steps: DataFrame, candidate: str | None) -> DataFrame:
    """The candidate's indicators beside those of the year before that there is in its ancestry, of which
    ``steps`` has one release for each reference year. The candidate is filtered after looking back."""
    history = indicator.join(relational.small_side(steps.select("release_id")), "release_id")
    order = F.struct("ano", "release_id").alias("order_")
    before = relational.previous_available(history.select("*", order), ["id_municipio", "rede"], "order_", "taxa_alfabetizacao", "taxa_ano_anterior")
    return before.where(F.col("release_id") == F.lit(candidate)).drop("order_").withColumn("variacao_pp", F.col("taxa_alfabetizacao") - F.col("taxa_ano_anterior"))


def hybrid(indicator: DataFrame, pointer: DataFrame, events: DataFrame) -> DataFrame:
    """The latest year of each municipality and network in the active release, overlaid by the events
    simulated after it was promoted. An ambiguous pointer gives no rows at all.

    ``pointer`` (release_id, promoted_at) is one row; ``events`` are settled: one row for each event id.
    """
    active = relational.only_if_single(pointer)
    of_release = indicator.join(F.broadcast(active.select("release_id")), "release_id")  # one row
    keep = [c for c in of_release.columns if c not in ("id_municipio", "rede")]
    batch = relational.latest(of_release, ["id_municipio", "rede"], ["ano"], keep)
    after = events.where("simulation").join(F.broadcast(active.select("promoted_at")), F.col("event_time") > F.col("promoted_at"))
    overlay = relational.latest(
        after, ["ano", "id_municipio", "rede"], ["event_time", "publish_time", "event_id"], ["correlation_id", "taxa_participacao", "taxa_alfabetizacao", "event_time", "event_id"]
    ).withColumnRenamed("taxa_alfabetizacao", "taxa_evento")
    return batch.join(overlay, ["ano", "id_municipio", "rede"], "left").select(
        "release_id", "correlation_id", "ano", "ano_particao", "id_municipio", "nome_municipio", "sigla_uf", "rede",
        F.col("taxa_participacao").alias("percentual_participacao"), F.col("event_time").alias("atualizado_em"),
        F.coalesce("taxa_evento", "taxa_alfabetizacao").alias("taxa_alfabetizacao"),
        F.when(F.col("event_id").isNull(), "batch_oficial").otherwise("stream_simulacao").alias("origem"),
    )


def published_comparison(compared: DataFrame, steps: DataFrame) -> DataFrame:
    """Of overlapping targets of published releases those of the latest reference year not after the
    target's, then of the nearest release."""
    rows = compared.join(relational.small_side(steps), "release_id").where(F.col("reference_year") <= F.col("ano_meta")).withColumn("near_", -F.col("chain_level"))
    keep = [c for c in compared.columns if c not in ("ano_meta", "nivel_geografico", "id_geografia", "rede")]
    return relational.latest(rows, ["ano_meta", "nivel_geografico", "id_geografia", "rede"], ["reference_year", "near_"], keep)
