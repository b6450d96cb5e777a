"""The quality gate: thirteen rules over the measurements of every release at once.

``measure`` reduces the tables to one row for each release, each measurement an aggregate of its own
that is combined before the shuffle; ``metrics`` turns that row into one row for each rule with its
metric, severity, action and details. A missing measurement counts as nothing measured: no rows, no
sources, no baseline. Comparisons with null are never a pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import medallion, quality, relational
from tessera.operators.medallion import LEVEL_NAMES, TABLES, TARGET_NAMES

# Names of the relations, the rules, and what a rule may ask for.
RELATIONS = (
    "alunos_diretorio_municipio", "municipio_diretorio", "uf_diretorio", "meta_municipio_diretorio", "meta_uf_diretorio",
    "meta_municipio_resultado", "resultado_uf_meta",
)
RULES = (
    "required_keys", "uniqueness_after_quarantine", "relationships", "gold_core_nulls", "optional_null_delta", "percentage_ranges",
    "non_negative_measurements", "proportions_sum", "repeated_evaluation_or_target_rate", "partition_volume", "pipeline_freshness",
    "identical_duplicate", "conflicting_duplicate",
)
PASS, WARNING, CRITICAL = "pass", "warning", "critical"
PROMOTE, ALERT, BLOCK, QUARANTINE, DEDUPLICATE = "promote", "continue_with_alert", "block_promotion", "quarantine_and_block", "deduplicate_and_alert"
#: The one incomplete target row that is known and only warned of.
KNOWN_GAP = {"ano": 2024, "sigla_uf": "RR", "rede": "publica", "reason_code": "taxa_alfabetizacao_and_percentual_participacao_missing"}


@dataclass(frozen=True)
class Inputs:
    """``staged`` and ``silver`` by the names of ``medallion.TABLES``; ``files`` (release_id, table_name,
    status, row_count, verified_at); ``releases`` (release_id, baseline_release_id, reference_year), one
    row for each release that is to be measured."""

    staged: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    directory: DataFrame
    files: DataFrame
    releases: DataFrame
    indicator: DataFrame = field(default=None)
    compared: DataFrame = field(default=None)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _is_known_gap() -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in KNOWN_GAP.items()]), F.lit(False))


# measurements ----------------------------------------------------------------------------------


def key_measures(silver: dict[str, DataFrame]) -> DataFrame:
    """Null and repeated business keys of the six silver tables, and how many of these have rows."""
    place = {"meta_brasil": F.lit("BRASIL"), "uf": F.col("sigla_uf"), "meta_uf": F.col("sigla_uf")}
    pupil = F.concat(F.col("id_escola"), F.lit("|"), F.col("id_aluno"))
    keys = relational.union_all([
        rows.select(
            F.lit(name).alias("t"), "release_id", "ano", place.get(name, F.col("id_municipio")).alias("g"), "rede",
            (pupil if name == "alunos" else F.lit(None).cast("string")).alias("x"),
        )
        for name, rows in silver.items()
    ])
    gone = lambda c: F.col(c).isNull() | (F.col(c) == "")
    bad = F.col("ano").isNull() | gone("g") | gone("rede") | ((F.col("t") == "alunos") & (F.col("x").isNull() | (F.col("x") == "|")))
    counted = keys.groupBy("t", "release_id", "ano", "g", "rede", "x").agg(F.count(F.lit(1)).alias("n"))
    hundred, n = F.lit(100.0), F.sum("n")
    return counted.groupBy("release_id").agg(
        F.countDistinct("t").alias("covered_silver_tables"), (hundred * F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)) / n).alias("null_rate"),
        (hundred * F.sum(F.col("n") - 1) / n).alias("duplicate_rate"),
    )


def source_measures(files: DataFrame, as_of: str) -> DataFrame:
    """Coverage of the six sources by the files selected, and the days since the oldest verification."""
    chosen = files.where("status = 'selected'")
    totals = chosen.groupBy("release_id", "table_name").agg(
        F.sum("row_count").alias("n"), F.max(F.date_diff(F.lit(as_of).cast("date"), F.to_date("verified_at"))).alias("days")
    )
    known = F.col("table_name").isin(*TABLES.values())
    return totals.groupBy("release_id").agg(
        F.count_if(known).alias("covered_sources"), F.count_if(known & (F.col("n") > 0)).alias("filled_sources"), F.count_if(~known).alias("unexpected_sources"),
        F.max("days").alias("days_since_success"),
    )


def rejection_measures(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("release_id").agg(F.count_if(_is_known_gap()).alias("rejected_known"), F.count_if(~_is_known_gap()).alias("rejected_unknown"))


def relationship_measures(inputs: Inputs) -> DataFrame:
    """(release_id, relation_name, checked_rows, missing_rows), all seven for each release. References are
    counted by key before they are looked up, and the other side is made unique."""
    s, by_id = inputs.silver, inputs.directory.select("id_municipio").distinct()
    states = inputs.directory.select("sigla_uf").where(F.col("sigla_uf").isNotNull()).distinct()
    key = ["release_id", "ano", "id_municipio", "rede"]
    targets = relational.unpivot(s["meta_uf"].where("rede = 'publica'"), ["release_id", "ano", "sigla_uf", "rede"], TARGET_NAMES, "name_", "meta_")
    targets = targets.withColumn("year_", F.expr("right(name_, 4)").cast("long")).where("ano <= year_").select("release_id", F.col("year_").alias("ano"), "sigla_uf", "rede")

    def check(name, child, parent, on):
        counted = child.groupBy("release_id", *[c for c in on if c != "release_id"]).agg(F.count(F.lit(1)).alias("n"))
        known = parent.select(*on).distinct().withColumn("hit_", F.lit(True))
        joined = counted.join(known, on, "left")
        return joined.groupBy("release_id").agg(
            F.lit(name).alias("relation_name"), F.sum("n").alias("checked"), F.sum(F.when(F.col("hit_").isNull(), F.col("n"))).alias("missing")
        )

    found = relational.union_all([
        check(RELATIONS[0], s["alunos"], by_id, ["id_municipio"]), check(RELATIONS[1], s["municipio"], by_id, ["id_municipio"]),
        check(RELATIONS[2], s["uf"], states, ["sigla_uf"]), check(RELATIONS[3], s["meta_municipio"], by_id, ["id_municipio"]),
        check(RELATIONS[4], s["meta_uf"], states, ["sigla_uf"]), check(RELATIONS[5], s["meta_municipio"].where("rede = 'municipal'"), s["municipio"], key),
        check(RELATIONS[6], s["uf"].where("rede = 'publica'"), targets, ["release_id", "ano", "sigla_uf", "rede"]),
    ])
    wanted = inputs.releases.select("release_id", F.explode(F.array(*[F.lit(r) for r in RELATIONS])).alias("relation_name"))
    return wanted.join(found, ["release_id", "relation_name"], "left").select(
        "release_id", "relation_name", _or_zero("checked").cast("long").alias("checked_rows"), _or_zero("missing").cast("long").alias("missing_rows")
    )


def relationship_shape(observed: DataFrame) -> DataFrame:
    """One row for each release: what was checked in all, and whether it was the relations expected."""
    expected = F.col("relation_name").isin(*RELATIONS)
    once = observed.groupBy("release_id", "relation_name").agg(F.count(F.lit(1)).alias("n"), F.sum("checked_rows").alias("c"), F.sum("missing_rows").alias("m"))
    zero = F.lit(0).cast("long")
    return once.groupBy("release_id").agg(
        F.sum("n").alias("actual_relationships"), F.count("relation_name").alias("distinct_relationships"),
        F.coalesce(F.sum(F.when(~expected, F.col("n"))), zero).alias("unexpected_relationships"),
        F.count_if(expected).alias("known_relationships"), F.count_if(expected & (F.col("c") > 0)).alias("filled_relationships"),
        F.coalesce(F.sum(F.when(expected, F.col("c"))), zero).alias("checked_rows"), F.coalesce(F.sum(F.when(expected, F.col("m"))), zero).alias("missing_rows"),
    )


def gold_measures(inputs: Inputs) -> DataFrame:
    """Rows of gold and how many of them lack what they must have. A comparison may lack its result only
    if the target lies after the release's reference year, and then wholly."""
    gone = lambda c: F.col(c).isNull() | (F.col(c) == "")
    null = lambda *names: reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    flat = inputs.indicator.select(
        "release_id", (null("ano", "taxa_alfabetizacao") | reduce(lambda a, b: a | b, [gone(c) for c in ("id_municipio", "rede", "nome_municipio", "sigla_uf")])).alias("bad")
    )
    result = ("taxa_resultado", "gap_pp", "status_meta")
    early = (F.col("ano_meta") <= F.col("reference_year")) | reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in result])
    partial = F.when(F.col("ano_resultado").isNull(), early).otherwise((F.col("ano_resultado") != F.col("ano_meta")) | null(*result))
    bad = null("ano_meta", "ano_referencia", "meta_alfabetizacao") | reduce(lambda a, b: a | b, [gone(c) for c in ("nivel_geografico", "id_geografia", "nome_geografia", "rede")]) | partial
    years = inputs.releases.select("release_id", "reference_year")
    compared = inputs.compared.join(relational.small_side(years), "release_id").select("release_id", bad.alias("bad"))
    return flat.unionByName(compared).groupBy("release_id").agg(F.count(F.lit(1)).alias("gold_rows"), F.count_if("bad").alias("gold_bad"))


def defect_measures(silver: dict[str, DataFrame]) -> DataFrame:
    """Rows out of range, negative, or with proportions that do not add up, over the tables that have such
    columns. The known gap is waived for its rate and participation only, never for its targets."""
    never = F.lit(False)
    outside_targets = quality.any_of([quality.outside(c) for c in TARGET_NAMES])
    required = quality.any_of([quality.missing_or_outside(c) for c in ("taxa_alfabetizacao", "percentual_participacao")])
    both_null = F.col("taxa_alfabetizacao").isNull() & F.col("percentual_participacao").isNull()
    waived = F.coalesce((F.col("ano") == KNOWN_GAP["ano"]) & (F.col("rede") == KNOWN_GAP["rede"]) & both_null, F.lit(False))
    negative_result = quality.negative_defects(["media_portugues", "taxa_alfabetizacao", *LEVEL_NAMES])
    negative_target = quality.negative_defects(["taxa_alfabetizacao", "percentual_participacao", *TARGET_NAMES])
    tests = {
        "municipio": (quality.range_defects_results(), negative_result, quality.proportion_defects()),
        "uf": (quality.range_defects_results(), negative_result, quality.proportion_defects()),
        "meta_municipio": (required | outside_targets, negative_target, never),
        "meta_uf": ((required & ~(waived & F.coalesce(F.col("sigla_uf") == KNOWN_GAP["sigla_uf"], F.lit(False)))) | outside_targets, negative_target, never),
        "meta_brasil": (required | outside_targets, negative_target, never),
        "alunos": (never, quality.negative_defects(["proficiencia", "peso_aluno"]), never),
    }
    goal = F.coalesce((F.col("rede") == "publica") & F.col("meta_alfabetizacao_2030").between(0, 100), F.lit(False))
    parts = [
        rows.groupBy("release_id").agg(
            *[F.count_if(t).alias(n) for t, n in zip(tests[name], ("ranges", "negatives", "proportions"), strict=True)],
            F.count_if(goal if name == "meta_brasil" else never).alias("goals"),
        )
        for name, rows in silver.items()
    ]
    return relational.union_all(parts).groupBy("release_id").agg(*[F.sum(c).alias(c) for c in ("ranges", "negatives", "proportions", "goals")])


def repeated_measures(staged_pupils: DataFrame) -> DataFrame:
    copies = staged_pupils.groupBy("release_id", "ano", "id_municipio", "id_escola", "id_aluno").agg(F.count(F.lit(1)).alias("n"))
    return copies.groupBy("release_id").agg((F.lit(100.0) * F.sum(F.col("n") - 1) / F.sum("n")).alias("repeated_rate"))


def duplicate_measures(candidates: DataFrame) -> DataFrame:
    """Copies beyond the first of keys that agree (of each run that has them), and keys that do not."""
    keys = medallion.duplicate_keys(candidates)
    once = keys.select("release_id", "table_name", "business_key_hash", "source_run_id", "copies", "kind").distinct()
    same = once.where("kind = 'identical'").groupBy("release_id").agg(F.sum(F.col("copies") - 1).alias("identical_copies"))
    other = once.where("kind = 'conflicting'").groupBy("release_id").agg(F.countDistinct("business_key_hash").alias("conflicting_keys"))
    return same.join(other, "release_id", "full")


def volume_measures(results: DataFrame, releases: DataFrame) -> DataFrame:
    """Rows and missing optional values of a release beside those of its baseline."""
    counted = quality.counts_by_release(results, n_null=F.col("media_portugues").isNull())
    base = counted.select(F.col("release_id").alias("baseline_release_id"), F.col("n_rows").alias("base_rows"), F.col("n_null").alias("base_null"))
    links = releases.select("release_id", "baseline_release_id")
    return links.join(counted, "release_id", "left").join(base, "baseline_release_id", "left").select(
        "release_id", _or_zero("n_rows").alias("target_rows"), _or_zero("n_null").alias("target_null"), _or_zero("base_rows").alias("base_rows"), _or_zero("base_null").alias("base_null")
    )


def measure(inputs: Inputs, as_of: str) -> DataFrame:
    """One row for each release with all measurements."""
    parts = [
        key_measures(inputs.silver), source_measures(inputs.files, as_of), rejection_measures(medallion.target_rejections(inputs.staged["meta_uf"])),
        relationship_shape(relationship_measures(inputs)), gold_measures(inputs), defect_measures(inputs.silver), repeated_measures(inputs.staged["alunos"]),
        duplicate_measures(medallion.duplicate_candidates(inputs.staged)), volume_measures(inputs.silver["municipio"], inputs.releases),
    ]
    return reduce(lambda rows, part: rows.join(part, "release_id", "left"), parts, inputs.releases.select("release_id"))


# rules -----------------------------------------------------------------------------------------


def _first(cases: list[tuple[Column, str]], default: str) -> Column:
    out = F.lit(default)
    for test, value in reversed(cases):
        out = F.when(F.coalesce(test, F.lit(False)), value).otherwise(out)
    return out


def metrics(measured: DataFrame) -> DataFrame:
    """(release_id, rule_id, metric_value, severity, action, details), thirteen rows for each release."""
    v, hundred, six, seven = _or_zero, F.lit(100.0), len(TABLES), len(RELATIONS)
    share = lambda a, b: F.when(b != 0, hundred * a / b)
    empty_sources = F.lit(six) - v("filled_sources")
    gaps = (F.lit(six) - v("covered_sources")) + empty_sources + v("unexpected_sources") + (F.lit(six) - v("covered_silver_tables"))
    known, unknown = v("rejected_known"), v("rejected_unknown")
    keys_broken = (v("null_rate") != 0) | (v("covered_sources") != six) | (empty_sources != 0) | (v("unexpected_sources") != 0) | (v("covered_silver_tables") != six) | (unknown != 0) | (known > 1)
    shaped = (v("actual_relationships") == seven) & (v("distinct_relationships") == seven) & (v("known_relationships") == seven) & (v("unexpected_relationships") == 0)
    related = shaped & (v("filled_relationships") == seven) & (v("missing_rows") == 0)
    gold_whole = (v("gold_rows") > 0) & (v("gold_bad") == 0)
    null_delta = share(v("target_null"), v("target_rows")) - share(v("base_null"), v("base_rows"))
    volume = share(v("target_rows") - v("base_rows"), v("base_rows"))
    no_base, no_target, shrunk, moved = v("base_rows") == 0, v("target_rows") == 0, volume < -50, F.abs(volume) > 20
    ranges = v("ranges") + F.when(v("goals") == 0, 1).otherwise(0)
    repeated, days = v("repeated_rate"), F.col("days_since_success")
    fresh = days <= 35

    def broken(test, severity=CRITICAL, action=QUARANTINE):
        return [(test, severity)], [(test, action)]

    rules = [
        (
            F.greatest(v("null_rate"), gaps, unknown, known - 1), [(keys_broken, CRITICAL), (known == 1, WARNING)], [(keys_broken, QUARANTINE), (known == 1, ALERT)],
            _first([((known == 1) & (unknown == 0), "six_non_empty_sources_and_silver_required_keys_with_rr_2024_publica_exception")], "six_non_empty_sources_and_silver_required_keys"),
        ),
        (v("duplicate_rate"), *broken(v("duplicate_rate") != 0), "six_silver_business_keys"),
        (
            F.least(F.coalesce(share(v("checked_rows") - v("missing_rows"), v("checked_rows")), F.lit(0.0)), F.when(shaped, hundred * v("filled_relationships") / seven).otherwise(0.0)),
            *broken(~related), "sete_relacoes_de_referencia",
        ),
        (share(v("gold_bad"), v("gold_rows")), *broken(~gold_whole, action=BLOCK), "non_empty_gold_core_and_directory_columns"),
        (null_delta, *broken(no_base | (null_delta > 5), WARNING, ALERT), _first([(no_base, "baseline_missing")], "media_portugues_pp_delta")),
        (ranges, *broken(ranges != 0), "required_rates_participation_optional_targets_brasil_publica_2030_required"),
        (v("negatives"), *broken(v("negatives") != 0), "silver_measurements"),
        (v("proportions"), *broken(v("proportions") != 0), "municipio_and_uf_sum_99_5_to_100_5"),
        (
            repeated, [(repeated <= 0.01, PASS), (repeated <= 0.50, WARNING), (F.lit(True), CRITICAL)],
            [(repeated <= 0.01, PROMOTE), (repeated <= 0.50, ALERT), (F.lit(True), QUARANTINE)], "stg_alunos_pre_deduplication",
        ),
        (
            F.abs(volume), [(no_base, WARNING), (no_target | shrunk, CRITICAL), (moved, WARNING)], [(no_target, BLOCK), (shrunk, BLOCK), (no_base | moved, ALERT)],
            _first([(no_base, "baseline_missing")], "silver_municipio_release_total"),
        ),
        (days, *broken(~F.coalesce(fresh, F.lit(False)), action=BLOCK), "oldest_selected_source_verification_days"),
        (v("identical_copies"), *broken(v("identical_copies") != 0, WARNING, DEDUPLICATE), "audit_identical_duplicates_excess_copies"),
        (v("conflicting_keys"), *broken(v("conflicting_keys") != 0), "quarantine_conflicting_business_keys"),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("rule_id"), metric.cast("double").alias("metric_value"), _first(severity, PASS).alias("severity"), _first(action, PROMOTE).alias("action"),
            (F.lit(details) if isinstance(details, str) else details).alias("details"),
        )
        for name, (metric, severity, action, details) in zip(RULES, rules, strict=True)
    ]
    return measured.select("release_id", F.explode(F.array(*rows)).alias("rule")).select("release_id", "rule.*")


def evaluate(measured_rules: DataFrame, registry: DataFrame, release_id: str) -> DataFrame:
    """The results of one candidate, to replace those it had: exactly one registry row of status
    ``succeeded`` with a baseline, and exactly the thirteen rules, or an error and no result."""
    is_it = F.col("release_id") == release_id
    state = registry.where(is_it & (F.col("status") == "succeeded") & F.col("baseline_release_id").isNotNull()).count()
    if state != 1:
        raise ValueError(f"{release_id} is no single candidate with a baseline")
    rows = measured_rules.where(is_it)
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("rule_id").alias("d"), F.count_if(~F.col("rule_id").isin(*RULES)).alias("x")).first()
    if (shape["n"], shape["d"], shape["x"]) != (len(RULES), len(RULES), 0):
        raise ValueError(f"the rules of {release_id} are not the catalogue's")
    return rows.withColumn("evaluated_at", F.current_timestamp())
