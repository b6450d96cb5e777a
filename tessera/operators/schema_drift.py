"""Schemas that drift between files: one fused schema, one table, and a report of every change.

Tagged-union inference. The schemas of a source's files are fused path by path: a path keeps every
alternative it has been seen with, under the tag of that alternative, instead of the widest type
alone. Alternatives come from the declared columns of the files and from the records themselves,
whose objects and arrays are followed to any depth. Each alternative of a file is fused with those of
the file after it: what only the later file has appears there, what only the earlier one has is gone,
and a path whose alternatives differ has changed. Records are read into typed branches, one per tag,
beside one canonical value of the fused type.

A path is the column's name and, below it, ``.key`` for a field of an object and ``[]`` for the
elements of an array; a key with a dot, bracket or backquote in it stands in backquotes.

Defined cases
* names ignore case and space around them; INTEGER is INT64 and FLOAT is FLOAT64; other types are
  compared as they are, in upper case; order alone is no change;
* repeated rows of a file's schema count once; of two columns of one name in one file the one with
  the smaller ordinal counts;
* a run is completed when any checkpoint says so; runs of one source and year are ordered by
  ``started_at`` (null first), then by id; a run without columns has an empty schema;
* rows without run id, source or name are no schema rows; broken or null records are listed with tag
  ``BROKEN`` and keep their text; a record that is no object is broken;
* a text is a number if it is written as one, with a point or a comma before the fraction; whole
  numbers are exact; a value of another type than its column's keeps its branch and has no canonical
  value (STRING columns take every single value as its text); an object or array has no text of its
  own, its fields have;
* of several schema hashes of a run's checkpoints the largest counts, null ones do not;
* empty tables give empty results; further columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The consistent table has at most this many columns; more names than that are no table.
MAX_COLUMNS = 5_000
#: Pairs of names that are read to find the families of columns.
MAX_PAIRS = 10 * MAX_COLUMNS

#: Spellings of one type.
TYPE_ALIASES = {"INTEGER": "INT64", "FLOAT": "FLOAT64"}


def canonical_type(name: F.Column) -> F.Column:
    plain = F.upper(F.trim(name))
    for alias, known in TYPE_ALIASES.items():
        plain = F.when(plain == alias, known).otherwise(plain)
    return plain


#: What is written as a number (once a comma is a point).
_NUMBER = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def number_text(text: F.Column) -> F.Column:
    """The text as a number is written, or null if it is none."""
    plain = F.replace(F.trim(text), F.lit(","), F.lit("."))
    return F.when(plain.rlike(_NUMBER), plain)


def whole_number(text: F.Column) -> F.Column:
    """The whole number that a text stands for ("3", "3.0", "3e2"), exactly, or null; a spelling that
    only a double has is taken up to 2^53, where doubles tell whole numbers apart."""
    plain = number_text(text)
    exact, rough = plain.try_cast("decimal(38,18)"), plain.try_cast("double")
    from_exact, from_rough = exact.try_cast("bigint"), rough.try_cast("bigint")
    return F.coalesce(
        plain.try_cast("bigint"),
        F.when(exact.isNotNull(), F.when(from_exact.cast("decimal(38,18)") == exact, from_exact))
        .when((from_rough.cast("double") == rough) & (F.abs(rough) <= F.lit(2.0**53)), from_rough),
    )


#: How the text of a single value becomes a value of a fused type; both readers use these.
CONVERT = {"INT64": whole_number, "FLOAT64": lambda text: number_text(text).try_cast("double"), "STRING": lambda text: text}


def file_schemas(inspection: DataFrame) -> DataFrame:
    """One row per run and column: name, ordinal, type and mode."""
    named = inspection.where(F.col("run_id").isNotNull() & F.col("column_name").isNotNull()).select(
        "run_id",
        F.lower(F.trim("column_name")).alias("name"),
        F.struct("ordinal", canonical_type(F.col("data_type")).alias("type"), F.upper(F.trim("column_mode")).alias("mode")).alias("has"),
    )
    return named.groupBy("run_id", "name").agg(F.min("has").alias("has"))


def completed_runs(manifest: DataFrame) -> DataFrame:
    """Completed runs, each with the completed runs before and after it in its source and year.

    The neighbours are found in two levels, within a day and then across days, so that no task sorts
    all runs of a busy source.
    """
    runs = (
        manifest.where(F.lower(F.trim("status")) == "completed")
        .where(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(F.min("source").alias("source"), F.min("year").alias("year"), F.min("started_at").alias("started_at"))
        .withColumn("day", F.to_date("started_at"))
    )
    order = [F.col("started_at").asc_nulls_first(), F.col("run_id")]
    inside = Window.partitionBy("source", "year", "day").orderBy(*order)
    ends = runs.groupBy("source", "year", "day").agg(F.max(F.struct("started_at", "run_id")).alias("last"), F.min(F.struct("started_at", "run_id")).alias("first"))
    across = Window.partitionBy("source", "year").orderBy(F.col("day").asc_nulls_first())
    ends = ends.select(
        F.col("source").alias("on_source"), F.col("year").alias("on_year"), F.col("day").alias("on_day"),
        F.lag("last.run_id").over(across).alias("earlier"), F.lead("first.run_id").over(across).alias("later"),
    )
    same_day = F.col("source").eqNullSafe(F.col("on_source")) & F.col("year").eqNullSafe(F.col("on_year")) & F.col("day").eqNullSafe(F.col("on_day"))
    return (
        runs.withColumn("before", F.lag("run_id").over(inside))
        .withColumn("after", F.lead("run_id").over(inside))
        .join(ends, same_day)
        .select("run_id", "source", "year", "started_at", F.coalesce("before", "earlier").alias("prior_run"), F.coalesce("after", "later").alias("next_run"))
    )


def fused_neighbours(schemas: DataFrame, runs: DataFrame) -> DataFrame:
    """The fusion of each run's schema with that of the run before it: one row per run and path with
    the alternatives ``now`` and ``prior`` (null where the file lacks the path). A file's alternatives
    are handed to the run itself and to the run after it, so one join and one aggregation do."""
    placed = schemas.join(runs.select("run_id", "prior_run", "next_run"), "run_id")
    uses = F.array_compact(F.array(
        F.when(F.col("prior_run").isNotNull(), F.struct(F.col("run_id").alias("at"), F.col("has").alias("now"), F.lit(None).cast(schemas.schema["has"].dataType).alias("prior"))),
        F.when(F.col("next_run").isNotNull(), F.struct(F.col("next_run").alias("at"), F.lit(None).cast(schemas.schema["has"].dataType).alias("now"), F.col("has").alias("prior"))),
    ))
    return placed.select("name", F.explode(uses).alias("use")).groupBy(F.col("use.at").alias("run_id"), "name").agg(
        F.max("use.now").alias("now"), F.max("use.prior").alias("prior")
    )


def changes(inspection: DataFrame, manifest: DataFrame) -> DataFrame:
    """Every change between a completed run and the one before it: (run_id, change_kind, column_name,
    prior_name). A new name is a rename where a name of the same type stood at its ordinal and is
    gone; ``prior_name`` is empty otherwise."""
    fused = fused_neighbours(file_schemas(inspection), completed_runs(manifest))
    now, prior = F.col("now"), F.col("prior")
    kinds = (
        F.when(prior.isNull(), F.array(F.lit("added")))
        .when(now.isNull(), F.array(F.lit("removed")))
        .otherwise(F.array_compact(F.array(
            F.when(~now["type"].eqNullSafe(prior["type"]), "retyped"), F.when(~now["mode"].eqNullSafe(prior["mode"]), "mode_changed")
        )))
    )
    # a name that came and a name that went from one place and type are one column under two names;
    # names that stayed take no place
    stayed = now.isNotNull() & prior.isNotNull()
    place = lambda part: F.when(~stayed, F.coalesce(now[part], prior[part]))
    moved = fused.select("run_id", "name", place("ordinal").alias("ordinal"), place("type").alias("type"), F.explode(kinds).alias("kind"))
    at = moved.groupBy("run_id", "ordinal", "type").agg(
        F.min(F.when(F.col("kind") == "removed", F.col("name"))).alias("old"),
        F.min(F.when(F.col("kind") == "added", F.col("name"))).alias("new"),
        F.collect_set(F.struct("kind", "name")).alias("all"),
    )
    paired = F.col("old").isNotNull() & F.col("new").isNotNull() & F.col("ordinal").isNotNull() & F.col("type").isNotNull()
    single = at.select("run_id", "old", "new", paired.alias("paired"), F.explode("all").alias("one"))
    is_old = F.col("paired") & (F.col("one.kind") == "removed") & (F.col("one.name") == F.col("old"))
    is_new = F.col("paired") & (F.col("one.kind") == "added") & (F.col("one.name") == F.col("new"))
    return single.where(~is_old).select(
        "run_id",
        F.when(is_new, "renamed").otherwise(F.col("one.kind")).alias("change_kind"),
        F.col("one.name").alias("column_name"),
        F.when(is_new, F.col("old")).otherwise("").alias("prior_name"),
    )


def hash_findings(inspection: DataFrame, manifest: DataFrame) -> DataFrame:
    """(run_id, finding) where a run's schema hash and its columns disagree about a change since the
    run before it: ``stale_hash`` (the columns changed, the hash did not) or ``unexplained_hash``."""
    done = manifest.where(F.lower(F.trim("status")) == "completed").groupBy("run_id").agg(F.max("schema_hash").alias("hash"))
    runs = completed_runs(manifest).where(F.col("prior_run").isNotNull()).select("run_id", "prior_run")
    before = done.select(F.col("run_id").alias("prior_run"), F.col("hash").alias("prior_hash"))
    changed = changes(inspection, manifest).select("run_id").distinct().withColumn("changed", F.lit(True))
    both = runs.join(done, "run_id").join(before, "prior_run").join(changed, "run_id", "left")
    same_hash = F.col("hash").eqNullSafe(F.col("prior_hash"))
    finding = F.when(F.col("changed").isNotNull() & same_hash, "stale_hash").when(F.col("changed").isNull() & ~same_hash, "unexplained_hash")
    return both.select("run_id", finding.alias("finding")).where(F.col("finding").isNotNull())


def declared_alternatives(inspection: DataFrame, manifest: DataFrame) -> DataFrame:
    """The fused schema of each source over all completed runs: one row per path and declared type
    with the number of runs and the first run (by start) in which the alternative appears."""
    joined = file_schemas(inspection).join(completed_runs(manifest), "run_id")
    return joined.groupBy("source", "name", F.col("has.type").alias("type")).agg(
        F.count(F.lit(1)).alias("n_runs"), F.min(F.struct("started_at", "run_id")).alias("first")
    ).select("source", F.col("name").alias("column_name"), F.col("type").alias("data_type"), "n_runs", F.col("first.run_id").alias("first_run"))


def _nesting(schemas: DataFrame) -> int:
    """How deep the objects and arrays of the records go, by the different shapes that they have."""
    shapes = schemas.distinct()
    level = F.aggregate(
        F.split("shape", ""), F.struct(F.lit(0).alias("at"), F.lit(0).alias("most")),
        lambda s, c: F.struct(
            (s["at"] + F.when(c == "<", 1).when(c == ">", -1).otherwise(0)).alias("at"), F.greatest(s["most"], s["at"] + F.when(c == "<", 1).otherwise(0)).alias("most")
        ),
        lambda s: s["most"],
    )
    return shapes.agg(F.max(level)).first()[0] or 0


def record_values(records: DataFrame) -> DataFrame:
    """All values of all records under their paths: (run_id, line_no, name, path, tag, as_text). The
    tag is INT64, FLOAT64, BOOL, STRING, NULL, OBJECT or ARRAY, and BROKEN (name and path empty) for
    what is no object. Objects and arrays are rows of their own and so are the values in them, level
    by level to the depth that the records have."""
    parsed = records.select("run_id", "line_no", "payload", F.try_parse_json("payload").alias("doc"))
    is_object = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT"), F.lit(False))
    kind = F.schema_of_variant("value")
    tag = (
        F.when(F.col("value").isNull() | F.is_variant_null("value"), "NULL")
        .when(kind == "BIGINT", "INT64")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "FLOAT64")
        .when(kind == "BOOLEAN", "BOOL")
        .when(kind.startswith("OBJECT"), "OBJECT")
        .when(kind.startswith("ARRAY"), "ARRAY")
        .otherwise("STRING")
    )
    quoted = F.when(F.col("key").rlike(r"[.\[\]`]"), F.concat(F.lit("`"), F.col("key"), F.lit("`"))).otherwise(F.col("key"))
    # an object of any depth one as a map of raw JSON values: they keep the difference of 1 and "1"
    level = parsed.where(is_object).select("run_id", "line_no", F.explode(F.expr("cast(doc as map<string, variant>)")).alias("key", "value"))
    name = F.lower(F.trim("key"))
    level = level.select("run_id", "line_no", name.alias("name"), F.lower(F.trim(quoted)).alias("path"), "value").withColumn("tag", tag)
    single = lambda rows: rows.select(
        "run_id", "line_no", "name", "path", "tag", F.when(~F.col("tag").isin("OBJECT", "ARRAY", "NULL"), F.expr("cast(value as string)")).alias("as_text")
    )
    out = single(level)
    for _ in range(1, _nesting(records.select(F.schema_of_variant(F.try_parse_json("payload")).alias("shape")))):
        fields = level.where("tag = 'OBJECT'").select("run_id", "line_no", "name", "path", F.explode(F.expr("cast(value as map<string, variant>)")).alias("key", "value"))
        fields = fields.select("run_id", "line_no", "name", F.concat("path", F.lit("."), quoted).alias("path"), "value")
        elements = level.where("tag = 'ARRAY'").select(
            "run_id", "line_no", "name", F.concat("path", F.lit("[]")).alias("path"), F.explode(F.expr("cast(value as array<variant>)")).alias("value")
        )
        level = fields.unionByName(elements).withColumn("tag", tag)
        out = out.unionByName(single(level))
    broken = parsed.where(~is_object).select(
        "run_id", "line_no", F.lit("").alias("name"), F.lit("").alias("path"), F.lit("BROKEN").alias("tag"), F.col("payload").alias("as_text")
    )
    return out.unionByName(broken)


def run_sources(inspection: DataFrame, manifest: DataFrame) -> DataFrame:
    """(run_id, source): of a run with several the smallest."""
    both = inspection.select("run_id", "source").unionByName(manifest.select("run_id", "source"))
    return both.where(F.col("run_id").isNotNull()).groupBy("run_id").agg(F.min("source").alias("source"))


def _width(kind: F.Column) -> F.Column:
    return F.when(kind == "INT64", 0).when(kind == "FLOAT64", 1).otherwise(2)


def fused_types(values: DataFrame, inspection: DataFrame, manifest: DataFrame) -> DataFrame:
    """(source, path, fused_type): INT64 or FLOAT64 where every alternative is that or narrower, else
    STRING. A declared path is fused from what was declared, any other from the values seen."""
    declared = declared_alternatives(inspection, manifest).groupBy("source", F.col("column_name").alias("path")).agg(F.max(_width(F.col("data_type"))).alias("width"))
    seen = values.where(~F.col("tag").isin("NULL", "BROKEN")).groupBy("source", "path").agg(F.max(_width(F.col("tag"))).alias("width"))
    both = declared.withColumn("known", F.lit(0)).unionByName(seen.withColumn("known", F.lit(1)))
    width = both.groupBy("source", "path").agg(F.min(F.struct("known", "width")).alias("first"))
    names = F.array(F.lit("INT64"), F.lit("FLOAT64"), F.lit("STRING"))
    return width.select("source", "path", F.element_at(names, F.col("first.width") + 1).alias("fused_type"))


def consistent_values(records: DataFrame, inspection: DataFrame, manifest: DataFrame) -> DataFrame:
    """Every value of every record of every run in one schema: in the branch of its own type
    (``as_...``) and converted to the fused type of its source and path (``canonical_...``, of which the
    one of that type is filled)."""
    values = record_values(records).join(run_sources(inspection, manifest), "run_id", "left")
    joined = values.join(fused_types(values, inspection, manifest), ["source", "path"], "left")
    text, tag = F.col("as_text"), F.col("tag")
    fits = tag.isin("INT64", "FLOAT64", "STRING")

    def canonical(kind, when):
        return F.when(when & (F.col("fused_type") == kind), CONVERT[kind](text)).alias(f"canonical_{kind.lower()}")

    return joined.select(
        "run_id", "line_no", "source", F.col("name").alias("column_name"), "path", "tag", "fused_type",
        F.when(tag == "INT64", text.try_cast("bigint")).alias("as_int64"),
        F.when(tag == "FLOAT64", text.try_cast("double")).alias("as_float64"),
        F.when(tag.isin("STRING", "BROKEN", "BOOL"), text).alias("as_string"),
        canonical("INT64", fits), canonical("FLOAT64", fits), canonical("STRING", tag != "BROKEN"),
    )


def observed_alternatives(records: DataFrame, inspection: DataFrame, manifest: DataFrame) -> DataFrame:
    """The tagged union as the records show it: one row per source, path and tag with its values, the
    runs that have it, the run (by start, then id) in which it appears first, and whether it was
    declared for that path. Runs that are not completed count as well; they may have no start."""
    starts = manifest.where(F.col("run_id").isNotNull()).groupBy("run_id").agg(F.min("started_at").alias("started_at"))
    values = record_values(records).where(~F.col("tag").isin("NULL", "BROKEN")).groupBy("run_id", "path", "tag").agg(F.count(F.lit(1)).alias("n"))
    placed = values.join(run_sources(inspection, manifest), "run_id", "left").join(starts, "run_id", "left")
    seen = placed.groupBy("source", "path", "tag").agg(
        F.sum("n").alias("n_values"), F.count(F.lit(1)).alias("n_runs"), F.min(F.struct("started_at", "run_id")).alias("first")
    )
    declared = declared_alternatives(inspection, manifest).select("source", F.col("column_name").alias("path"), F.col("data_type").alias("tag"), F.lit(True).alias("was"))
    return seen.join(declared, ["source", "path", "tag"], "left").select(
        "source", "path", "tag", "n_values", "n_runs", F.col("first.run_id").alias("first_run"), F.col("was").isNotNull().alias("declared")
    )


def _checked(pairs: DataFrame, what: str) -> list:
    rows = pairs.limit(MAX_PAIRS + 1).collect()
    if len(rows) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} {what}")
    return rows


def _merged(names, links: list[tuple[str, str]], clashes: set[frozenset[str]]) -> dict[str, set[str]]:
    """Each name's family: linked names, but no two that clash."""
    family = {name: {name} for name in names}
    for old, new in links:
        if family[old] is not family[new] and not any(frozenset((a, b)) in clashes for a in family[old] for b in family[new]):
            merged = family[old] | family[new]
            for name in merged:
                family[name] = merged
    return family


def column_families(inspection: DataFrame, manifest: DataFrame) -> dict[str, tuple[list[str], str]]:
    """Name of each column of the consistent table -> (the names it has had, its fused type).

    Names linked by reported renames are one column, called by the name that most runs have, unless
    any two of them stand in one file somewhere. The names of a table's columns are what is read here,
    so their number is checked; more than ``MAX_COLUMNS`` is an error, as are more than ``MAX_PAIRS``
    renames or pairs of one file.
    """
    schemas = file_schemas(inspection)
    types = schemas.groupBy("name").agg(F.collect_set("has.type").alias("types"), F.count(F.lit(1)).alias("n")).limit(MAX_COLUMNS + 1).collect()
    if len(types) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} column names")
    renames = changes(inspection, manifest).where("change_kind = 'renamed'").select("prior_name", "column_name").distinct()
    links = sorted(tuple(r) for r in _checked(renames, "renames"))
    linked = _merged([r["name"] for r in types], links, set())
    # only names that renames link, directly or not, can come into one family
    groups = [(name, min(names)) for name, names in linked.items() if len(names) > 1]
    clashes = set()
    if groups:
        grouped = schemas.select("run_id", "name").join(F.broadcast(schemas.sparkSession.createDataFrame(groups, "name string, linked string")), "name")
        first, second = (grouped.withColumnRenamed("name", c) for c in ("a", "b"))
        together = first.join(second, ["run_id", "linked"]).where("a < b").select("a", "b").distinct()
        clashes = {frozenset(r) for r in _checked(together, "pairs of names in one file")}
    family = _merged(linked, links, clashes)
    seen, runs = {r["name"]: set(r["types"]) for r in types}, {r["name"]: r["n"] for r in types}
    out = {}
    for names in {id(f): f for f in family.values()}.values():
        kinds = set().union(*(seen[n] for n in names))
        fused = "INT64" if kinds == {"INT64"} else "FLOAT64" if kinds <= {"INT64", "FLOAT64"} else "STRING"
        ordered = sorted(names, key=lambda n: (-runs[n], n))
        out[ordered[0]] = (ordered, fused)
    return dict(sorted(out.items()))


def with_fields(records: DataFrame) -> DataFrame:
    """The records with the fields of their payload as texts by name (``has_``, null for what is no
    object); of names that differ in case only, the last stays."""
    entries = F.expr("transform(map_entries(cast(doc_ as map<string, variant>)), e -> struct(lower(trim(e.key)) as key, cast(e.value as string) as value))")
    is_object = F.coalesce(F.schema_of_variant("doc_").startswith("OBJECT"), F.lit(False))
    latest = F.aggregate(
        F.when(is_object, entries), F.expr("cast(map() as map<string, string>)"),
        lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])),
    )
    return records.withColumn("doc_", F.try_parse_json("payload")).withColumn("has_", latest).drop("doc_")


def consistent_table(records: DataFrame, inspection: DataFrame, manifest: DataFrame) -> DataFrame:
    """One wide table over all files: run_id_, line_no_, then a column per family in its fused type;
    ``unconverted_`` has by name the values that have no place in it (of another type, of a name no
    schema knows, or beside another value of the same family) and ``broken_`` the text of what is no object. One pass, no shuffle of records."""
    families = column_families(inspection, manifest)
    parsed = with_fields(records.select(F.col("run_id").alias("run_id_"), F.col("line_no").alias("line_no_"), "payload"))
    rows = parsed.select("run_id_", "line_no_", F.when(F.col("has_").isNull(), F.col("payload")).alias("broken_"), F.col("has_").alias("has"))
    columns = []
    family_of = {name: (column, kind) for column, (names, kind) in families.items() for name in names}
    for column, (names, kind) in families.items():
        columns.append(F.coalesce(*[CONVERT[kind](F.element_at("has", n)) for n in names]).alias(column))
    numeric = [name for name, (_, kind) in family_of.items() if kind != "STRING"]
    whole = [name for name, (_, kind) in family_of.items() if kind == "INT64"]
    known = F.array(*[F.lit(n) for n in family_of]).cast("array<string>")
    numbers, wholes = (F.array(*[F.lit(n) for n in names]).cast("array<string>") for names in (numeric, whole))
    lost = F.map_filter(
        "has",
        lambda k, v: v.isNotNull()
        & (
            ~F.array_contains(known, k)
            | (F.array_contains(wholes, k) & CONVERT["INT64"](v).isNull())
            | (F.array_contains(numbers, k) & ~F.array_contains(wholes, k) & CONVERT["FLOAT64"](v).isNull())
        ),
    )
    # of a record with several names of one family the first that converts is placed, the others are left
    def beyond_first(names, kind):
        held = F.array(*[F.struct(F.lit(n).alias("key"), F.element_at("has", n).alias("value")) for n in names])
        return F.slice(F.filter(held, lambda e: CONVERT[kind](e["value"]).isNotNull()), 2, len(names))

    left = [beyond_first(names, kind) for names, kind in families.values() if len(names) > 1]
    if left:
        lost = F.map_concat(lost, F.map_from_entries(F.flatten(F.array(*left))))
    return rows.select("run_id_", "line_no_", *columns, lost.alias("unconverted_"), "broken_")
