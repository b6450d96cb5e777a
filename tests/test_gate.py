import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators import gate, medallion

GOOD = {
    "release_id": "r", "null_rate": 0.0, "duplicate_rate": 0.0, "covered_silver_tables": 6, "covered_sources": 6, "filled_sources": 6, "unexpected_sources": 0,
    "days_since_success": 3, "rejected_known": 0, "rejected_unknown": 0, "actual_relationships": 7, "distinct_relationships": 7, "known_relationships": 7,
    "unexpected_relationships": 0, "filled_relationships": 7, "checked_rows": 7, "missing_rows": 0, "gold_rows": 1, "gold_bad": 0, "ranges": 0, "goals": 1,
    "negatives": 0, "proportions": 0, "repeated_rate": 0.0, "identical_copies": 0, "conflicting_keys": 0, "target_rows": 100, "target_null": 0, "base_rows": 100, "base_null": 0,
}
SCHEMA = ", ".join(f"{c} {'string' if c == 'release_id' else 'double' if c.endswith('_rate') else 'long'}" for c in GOOD)


def rules(spark, **changed):
    row = GOOD | changed
    found = gate.metrics(spark.createDataFrame([tuple(row[c] for c in GOOD)], SCHEMA)).collect()
    assert [r["rule_id"] for r in found] == list(gate.RULES)
    return {r["rule_id"]: (r["metric_value"], r["severity"], r["action"]) for r in found}


def odd(spark, **changed):
    return {k: v for k, v in rules(spark, **changed).items() if v[1] != "pass"}


def test_a_good_release_passes_all_rules(spark):
    assert odd(spark) == {} and rules(spark)["relationships"] == (100.0, "pass", "promote") and rules(spark)["pipeline_freshness"][0] == 3


BLOCKED = ("critical", "quarantine_and_block")


@pytest.mark.parametrize(("changed", "found"), [
    ({"rejected_known": 1}, {"required_keys": (0, "warning", "continue_with_alert")}),
    ({"rejected_known": 2}, {"required_keys": (1, *BLOCKED)}),
    ({"rejected_unknown": 4}, {"required_keys": (4, *BLOCKED)}),
    ({"covered_sources": 5, "filled_sources": 5}, {"required_keys": (2, *BLOCKED)}),
    ({"covered_sources": None, "filled_sources": None, "covered_silver_tables": None}, {"required_keys": (18, *BLOCKED)}),
    ({"filled_relationships": 6, "checked_rows": 6}, {"relationships": (100 * 6 / 7, *BLOCKED)}),
    ({"missing_rows": 35, "checked_rows": 42}, {"relationships": (100 * 7 / 42, *BLOCKED)}),
    ({"actual_relationships": 8}, {"relationships": (0, *BLOCKED)}),
    ({"gold_rows": 0}, {"gold_core_nulls": (None, "critical", "block_promotion")}),
    ({"gold_rows": 4, "gold_bad": 1}, {"gold_core_nulls": (25, "critical", "block_promotion")}),
    ({"goals": 0}, {"percentage_ranges": (1, *BLOCKED)}),
    ({"target_null": 6}, {"optional_null_delta": (6, "warning", "continue_with_alert")}),
    ({"target_null": 5}, {}),
    ({"repeated_rate": 0.01}, {}),
    ({"repeated_rate": 0.011}, {"repeated_evaluation_or_target_rate": (0.011, "warning", "continue_with_alert")}),
    ({"repeated_rate": 0.5}, {"repeated_evaluation_or_target_rate": (0.5, "warning", "continue_with_alert")}),
    ({"repeated_rate": 0.51}, {"repeated_evaluation_or_target_rate": (0.51, *BLOCKED)}),
    ({"target_rows": 50}, {"partition_volume": (50, "warning", "continue_with_alert")}),
    ({"target_rows": 49}, {"partition_volume": (51, "critical", "block_promotion")}),
    ({"target_rows": 120}, {}),
    ({"target_rows": 121}, {"partition_volume": (21, "warning", "continue_with_alert")}),
    ({"days_since_success": 35}, {}),
    ({"days_since_success": 36}, {"pipeline_freshness": (36, "critical", "block_promotion")}),
    ({"days_since_success": None}, {"pipeline_freshness": (None, "critical", "block_promotion")}),
    ({"identical_copies": 2}, {"identical_duplicate": (2, "warning", "deduplicate_and_alert")}),
    ({"conflicting_keys": 1}, {"conflicting_duplicate": (1, *BLOCKED)}),
])
def test_edges_of_the_rules(spark, changed, found):
    assert odd(spark, **changed) == found


def test_without_baseline_severity_and_action_differ(spark):
    got = odd(spark, base_rows=0, target_rows=0)
    assert got["partition_volume"] == (None, "warning", "block_promotion") and got["optional_null_delta"][1:] == ("warning", "continue_with_alert")


def test_relations_by_shape(spark):
    rows = [("r", name, 1, 0) for name in gate.RELATIONS[1:]] + [("r", "other", 5, 5), ("r", gate.RELATIONS[1], 0, 0), ("s", gate.RELATIONS[0], 0, 0)]
    got = {r["release_id"]: r for r in gate.relationship_shape(spark.createDataFrame(rows, "release_id string, relation_name string, checked_rows long, missing_rows long")).collect()}
    assert (got["r"]["actual_relationships"], got["r"]["distinct_relationships"], got["r"]["known_relationships"], got["r"]["unexpected_relationships"]) == (8, 7, 6, 1)
    assert (got["r"]["filled_relationships"], got["r"]["checked_rows"], got["r"]["missing_rows"]) == (6, 6, 0) and got["s"]["filled_relationships"] == 0


def test_results_of_one_candidate(spark):
    metrics = gate.metrics(spark.createDataFrame([tuple(GOOD.values())], SCHEMA))
    registry = lambda *rows: spark.createDataFrame(list(rows), "release_id string, status string, baseline_release_id string")
    assert gate.evaluate(metrics, registry(("r", "succeeded", "b")), "r").count() == 13
    for rows in ([("r", "running", "b")], [("r", "succeeded", None)], [("r", "succeeded", "b")] * 2, [("x", "succeeded", "b")]):
        with pytest.raises(ValueError, match="candidate"):
            gate.evaluate(metrics, registry(*rows), "r")
    with pytest.raises(ValueError, match="catalogue"):
        gate.evaluate(metrics.where("rule_id <> 'relationships'"), registry(("r", "succeeded", "b")), "r")


# gold ------------------------------------------------------------------------------------------

AT = dt.datetime(2024, 6, 1)
MEASURES = "".join(f", {c} decimal(28,9)" for c in medallion.TARGET_NAMES)


def targets(spark, place, *rows):
    """Rows (year, place, network, rate, targets by year)."""
    made = [("r", year, key, network, Decimal(rate) if rate else None, *[Decimal(goals[y]) if y in goals else None for y in range(2024, 2031)]) for year, key, network, rate, goals in rows]
    return spark.createDataFrame(made, f"release_id string, ano long, {place} string, rede string, taxa_alfabetizacao decimal(28,9){MEASURES}")


def results(spark, *rows):
    made = [("r", year, dt.date(year, 1, 1), place, network, Decimal(rate), None, *[None] * 9) for year, place, network, rate in rows]
    levels = "".join(f", {c} decimal(28,9)" for c in medallion.LEVEL_NAMES)
    return spark.createDataFrame(made, f"release_id string, ano long, ano_particao date, id_municipio string, rede string, taxa_alfabetizacao decimal(28,9), media_portugues decimal(28,9){levels}")


def names(spark):
    rows = [("3550308", "São Paulo", "SP", None), ("3550308", "São Paulo", "SP", None), ("1", "Old", "XX", dt.date(2020, 1, 1))]
    return medallion.current_directory(spark.createDataFrame(rows, "id_municipio string, nome string, sigla_uf string, excluido_em date"))


def test_targets_and_results_on_three_levels(spark):
    flat = medallion.indicators(results(spark, (2024, "3550308", "municipal", 68), (2024, "3550308", "total", 99), (2024, "1", "municipal", 5)), names(spark))
    assert flat.count() == 2
    tables = {
        "meta_municipio": targets(spark, "id_municipio", (2023, "3550308", "municipal", None, {2024: 65, 2030: 90}), (2024, "3550308", "municipal", None, {2024: 67}), (2024, "3550308", "total", None, {2024: 99})),
        "meta_uf": targets(spark, "sigla_uf", (2023, "SP", "publica", 69, {2024: 72}), (2024, "SP", "publica", 73, {}), (2024, "SP", "estadual", 99, {2024: 1})),
        "meta_brasil": targets(spark, "x", (2023, None, "publica", 68, {2024: 71}), (2024, None, "publica", 70, {}), (2024, None, "privada", 99, {2024: 1})),
        "uf": spark.createDataFrame([("r", 2024, "SP", "publica", Decimal(74)), ("r", 2024, "SP", "estadual", Decimal(99))], "release_id string, ano long, sigla_uf string, rede string, taxa_alfabetizacao decimal(28,9)"),
    }
    got = {tuple(r) for r in medallion.comparison(tables, flat, names(spark)).select(
        "nivel_geografico", "id_geografia", "nome_geografia", "ano_meta", "ano_referencia", "ano_resultado", *[F.col(c).cast("double") for c in ("meta_alfabetizacao", "taxa_resultado", "gap_pp")], "status_meta",
    ).collect()}
    assert got == {
        ("municipio", "3550308", "São Paulo", 2024, 2024, 2024, 67.0, 68.0, 1.0, "atingida"), ("municipio", "3550308", "São Paulo", 2030, 2023, None, 90.0, None, None, None),
        ("uf", "SP", "SP", 2024, 2023, 2024, 72.0, 74.0, 2.0, "atingida"), ("brasil", "BRASIL", "Brasil", 2024, 2023, 2024, 71.0, 70.0, -1.0, "nao_atingida"),
    }


def test_the_overlay_takes_later_simulated_events_alone(spark):
    flat = medallion.indicators(results(spark, (2023, "3550308", "municipal", 50), (2024, "3550308", "municipal", 68), (2024, "3550308", "total", 60)), names(spark))
    hour = lambda d, s: dt.datetime(2024, 6, d, 0, 0, s)
    event = lambda i, d, s, rate, network="municipal", simulated=True: (i, hour(d, 0), hour(d, s), 2024, "3550308", network, Decimal(rate), None, f"run-{i}", simulated)
    events = spark.createDataFrame(
        [event("old", 1, 0, 66), event("a", 2, 1, 71), event("z", 2, 2, 72), event("real", 3, 1, 99, simulated=False), event("y", 2, 2, 70)],
        "event_id string, event_time timestamp, publish_time timestamp, ano long, id_municipio string, rede string, taxa_alfabetizacao decimal(28,9), taxa_participacao decimal(28,9), correlation_id string, simulation boolean",
    )
    pointer = lambda *ids: spark.createDataFrame([(i, hour(1, 0)) for i in ids], "release_id string, promoted_at timestamp")
    got = {(r["rede"], float(r["taxa_alfabetizacao"]), r["correlation_id"], r["origem"]) for r in medallion.hybrid(flat, pointer("r"), events).collect()}
    assert got == {("municipal", 72.0, "run-z", "stream_simulacao"), ("total", 60.0, None, "batch_oficial")}
    assert medallion.hybrid(flat, pointer("r", "q"), events).count() == medallion.hybrid(flat, pointer(), events).count() == 0


def test_evolution_looks_back_over_what_is_published(spark):
    flat = medallion.indicators(results(spark, (2023, "3550308", "municipal", 60), (2024, "3550308", "municipal", 68)), names(spark))
    by = {2023: "before", 2024: "r"}
    flat = flat.withColumn("release_id", F.when(F.col("ano") == 2023, by[2023]).otherwise("r"))
    flat = flat.unionByName(flat.where("ano = 2024").withColumn("release_id", F.lit("same-year-old")).withColumn("taxa_alfabetizacao", F.lit(10).cast("decimal(28,9)")))
    steps = spark.createDataFrame([("r",), ("before",)], "release_id string")
    got = [(float(r["taxa_alfabetizacao"]), float(r["taxa_ano_anterior"]), float(r["variacao_pp"])) for r in medallion.evolution(flat, steps, "r").collect()]
    assert got == [(68.0, 60.0, 8.0)]


def test_staging_normalises_every_source(spark):
    origin = ("r", "run", AT)
    pupils = [(*origin, "2024", " 12 ", " ", "x1", "1", "2", "3", "s", "n", "s", "1.5", "x")]
    schema = "release_id string, source_run_id string, ingested_at timestamp, " + ", ".join(f"{c} string" for c, _ in medallion.contract("alunos").columns)
    row = medallion.stage(spark.createDataFrame(pupils, schema), "alunos").first()
    assert (row["ano"], row["id_municipio"], row["id_escola"], row["id_aluno"], row["rede"], row["proficiencia"], row["peso_aluno"]) == (2024, "0000012", None, "x1", "municipal", Decimal("1.5"), None)
    columns = [c for c, _ in medallion.contract("meta_alfabetizacao_uf").columns]
    raw = spark.createDataFrame([(*origin, *["2024.5" if c == "ano" else " rr " if c == "sigla_uf" else "Pública" if c == "rede" else None for c in columns])],
                                "release_id string, source_run_id string, ingested_at timestamp, " + ", ".join(f"{c} string" for c in columns))
    staged = medallion.stage(raw, "meta_uf")
    assert [staged.first()[c] for c in ("ano", "sigla_uf", "rede", "ano_particao")] == [None, "RR", "publica", None]
    assert [r["reason_code"] for r in medallion.target_rejections(staged).collect()] == ["taxa_alfabetizacao_and_percentual_participacao_missing"]


def test_copies_of_all_tables(spark):
    rows = [("r", "uf", "a", AT, "k1", "h"), ("r", "uf", "a", AT, "k1", "h"), ("r", "uf", "b", AT, "k1", "h"), ("r", "uf", "a", AT, "k2", "h"), ("r", "uf", "a", AT, "k2", "i"), ("r", "meta_uf", "a", AT, "k2", "i"), ("r", "meta_uf", "b", AT, "k2", "j")]
    candidates = spark.createDataFrame(rows, "release_id string, table_name string, source_run_id string, ingested_at timestamp, business_key_hash string, row_hash string")
    assert {(r["source_run_id"], r["copies"]) for r in medallion.identical_copies(candidates).collect()} == {("a", 3), ("b", 3)}
    assert medallion.conflicting_copies(candidates).count() == 4
    found = gate.duplicate_measures(candidates).first()
    assert (found["identical_copies"], found["conflicting_keys"]) == (4, 1)  # a key of both runs counts for each; equal keys of two tables are one
