"""Plan an import run: validate every catalogued resource and report its outcome.

The whole run is one plan over the catalogue. Reading the resources themselves is the work
of ``concordat.sources``; what happened there comes back as the ``outcomes`` table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions.casts import blank_to_null
from concordat.names import Names
from concordat.operators.catalog import iso
from concordat.operators.dedupe import first_per_key

# Roles that are imported, and defaults for blank fields.
IMPORTED_ROLES = ("source", "perimetre")
DEFAULT_ROLE, DEFAULT_TARGET, ARCHIVE = "source", "prod", "archive"
# Fixed value: the end of validity of whatever was not removed yet.
NEVER_REMOVED = "2100-01-01T00:00:00"
# Source names looked for in a resource's name when it declares none.
KNOWN_SOURCES = ("canalisations_en_service", "canalisations_abandonnees", "reparations")
# Use case -> (table prefix, schema). Platforms add their own.
USE_CASES = {
    "apcom": ("apcom", "appuiscommuns"),
    "sdirve": ("sdirve", "sdirve"),
    "eaupotable": ("eaupot", "eaupotable"),
    "eclairage_public": ("eclpub", "eclairage_public"),
}
# Columns of the catalogue that name a resource in the state, before the step and the environment.
RESOURCE_KEY = ("org_name", "ds_name", "name", "id")
STEPS = ("download", "insert")
# Format of a resource -> the step that reads it.
READERS = {"csv": "read_delimited", "geojson": "read_geojson", "parquet": "read_parquet"}


def _lookup(mapping: Mapping[str, object], key: Column) -> Column:
    literal = F.create_map(*[F.lit(v) for item in mapping.items() for v in item])
    return F.try_element_at(literal, key)


def _message(condition: Column, status: str, text: Column) -> Column:
    return F.when(condition, F.struct(F.lit(status).alias("status"), text.alias("text")))


def resource_key(step: str, environment: str) -> Column:
    return F.concat_ws("/", *RESOURCE_KEY, F.lit(step), F.lit(environment))


def owner_id(siren: Column, org_id: Column, org_name: Column) -> Column:
    """The declared number, else a code from the organisation, in characters safe for a table name."""
    own = F.concat(F.substring(org_id, 1, 4), F.right(org_name, F.lit(6)))
    return F.regexp_replace(F.lower(F.coalesce(blank_to_null(siren), own)), "[^a-zA-Z0-9_]", "")


def plan_imports(
    catalog: DataFrame,
    state: DataFrame,
    use_cases: Mapping[str, tuple[str, str]] = USE_CASES,
    known_sources: Sequence[str] = KNOWN_SOURCES,
    readers: Mapping[str, str] = READERS,
    environment: str = "prod",
    run_start: str | None = None,
    outcomes: DataFrame | None = None,
    names: Names = Names(),
) -> DataFrame:
    """One report row per imported resource, with status, target table and messages.

    ``state`` is ``(resource_key, timestamp, status)`` as kept by ``next_state``. ``outcomes`` is
    ``(resource_id, step, error)`` with step ``download`` or ``insert`` for what failed in this run.
    """
    field = {f: F.col(f.lower()) for f in names.fields}
    role = F.coalesce(blank_to_null(field[names.role]), F.lit(DEFAULT_ROLE))
    by_name = F.coalesce(*[F.when(F.col("name").contains(s), F.lit(s)) for s in known_sources])
    stamp = iso(F.greatest(F.col("last_modified"), F.col("ds_metadata_modified")))
    started = F.lit(run_start) if run_start else iso(F.current_timestamp())

    prepared = (
        catalog.withColumn("__role", role)
        .filter(F.col("__role").isin(*IMPORTED_ROLES))
        .select(
            "id", "name", "ds_id", "ds_name", "ds_title", "org_id", "org_name", "org_title", "u_email", "url",
            field[names.use_case].alias(names.use_case),
            F.col("__role").alias(names.role),
            F.coalesce(blank_to_null(field[names.source]), by_name).alias(names.source),
            F.coalesce(blank_to_null(field[names.target]), F.lit(DEFAULT_TARGET)).alias(names.target),
            _lookup({k: v[0] for k, v in use_cases.items()}, field[names.use_case]).alias("use_case_prefix"),
            _lookup({k: v[1] for k, v in use_cases.items()}, field[names.use_case]).alias("schema"),
            owner_id(F.col(names.siren.lower()), F.col("org_id"), F.col("org_name")).alias("data_owner_id"),
            F.lower(F.coalesce("format", F.regexp_extract("name", r"\.([^.]*)$", 1))).alias("format"),
            stamp.alias("last_changed"),
            F.when(stamp.isNotNull(), iso(F.col("ds_metadata_created"))).alias("added"),
            F.concat_ws("/", *RESOURCE_KEY).alias("__base"),
        )
        .join(_seen(state, environment), "__base", "left")
        .withColumns({
            f"__{s}_changed": ~F.coalesce(F.col(f"__{s}_seen") == F.col("last_changed"), F.lit(False)) for s in STEPS
        })
    )
    prepared = _with_outcomes(prepared, outcomes)

    archived = F.col(names.target) == ARCHIVE
    # An unchanged resource whose last download failed keeps reporting that failure.
    failed_before = ~F.col("__download_changed") & (F.coalesce("__download_status", F.lit("success")) != "success")
    download_error = F.when(failed_before, F.col("__download_status")).when(
        F.col("__download_changed"), F.col("__download_error")
    )
    first_messages = F.array(
        _message(F.col("schema").isNull(), "error", F.lit(f"undefined {names.use_case}")),
        _message(F.col(names.source).isNull(), "error", F.lit(f"missing {names.source}")),
        _message(~archived & download_error.isNotNull(), "error",
                 F.concat(F.lit("while downloading, "), download_error)),
        _message(archived, "skipped", F.lit("is archive so skipped import")),
    )
    staged = prepared.withColumn("__messages", F.array_compact(first_messages)).withColumn(
        "table",
        F.when(
            ~archived & ~F.exists("__messages", lambda m: m["status"] == "error"),
            F.concat_ws("_", "use_case_prefix", F.lit("raw"), names.source, "data_owner_id"),
        ),
    )

    # The least resource id owns a table; any other resource naming it is in error.
    holders = (
        staged.filter(F.col("table").isNotNull()).groupBy("schema", "table").agg(F.min("id").alias("__holder"))
    )
    # Resources without a table get a key of their own, else they would all meet in one task.
    place = F.concat_ws(".", "schema", "table")
    key = F.when(F.col("table").isNull(), F.concat(F.lit("/"), "id")).otherwise(place)
    held = holders.select(place.alias("__place"), "__holder")
    checked = (
        staged.withColumn("__place", key).join(held, "__place", "left")
        .withColumn("__collides", F.coalesce(F.col("id") > F.col("__holder"), F.lit(False)))
    )

    reader = _lookup(readers, F.col("format"))
    active = F.col("table").isNotNull() & ~F.col("__collides")
    imports = active & F.col("__insert_changed")
    error_text = F.when(reader.isNull(), F.lit("unsupported format")).otherwise(
        F.translate("__insert_error", '"', "'")
    )
    later_messages = F.array(
        _message(F.col("__collides"), "error",
                 F.concat(F.lit("schema and table duplicate "), F.concat_ws(".", "schema", "table"))),
        _message(imports & error_text.isNotNull(), "error", error_text),
        _message(active & ~F.col("__insert_changed"), "success",
                 F.concat(F.lit("no change, already imported at "), F.col("last_changed"))),
    )
    step = F.when(imports & reader.isNotNull(), reader).when(
        active & ~F.col("__insert_changed"), F.lit("no change, skipped")
    ).otherwise(F.lit("prepare"))
    reported = checked.withColumn("__all", F.concat("__messages", F.array_compact(later_messages))).select(
        *names.fields,
        _roll_up(F.col("__all")).alias("status"),
        started.alias("start"),
        started.alias("imported"),
        F.lit("concordat").alias("component"),
        step.alias("step"),
        "last_changed", "added", F.lit(NEVER_REMOVED).alias("removed"),
        F.col("id").alias("resource_id"), F.col("name").alias("resource_name"),
        F.col("ds_id").alias("dataset_id"), F.col("ds_name").alias("dataset_name"),
        F.col("ds_title").alias("dataset_title"),
        "org_id", "org_name", "org_title", "data_owner_id", "u_email", "format",
        F.when(~archived & download_error.isNull(), F.col("url")).alias("source_file_path"),
        "schema", "table", "use_case_prefix",
        F.to_json("__all").alias("messages"),
    )
    return reported.select(*names.report)


def _seen(state: DataFrame, environment: str) -> DataFrame:
    """The kept state with one row per resource: ``__<step>_seen`` and ``__<step>_status``."""
    parts = []
    for step in STEPS:
        end = f"/{step}/{environment}"
        mine = F.col("resource_key").endswith(end)
        base = F.substring("resource_key", F.lit(1), F.length("resource_key") - len(end))
        parts.append(F.when(mine, F.struct(base.alias("__base"), F.lit(step).alias("step"), "timestamp", "status")))
    kept = state.select(F.coalesce(*parts).alias("s")).filter(F.col("s").isNotNull()).select("s.*")
    return kept.groupBy("__base").agg(*[
        F.min(F.when(F.col("step") == step, F.col(c))).alias(f"__{step}_{n}")
        for step in STEPS for c, n in (("timestamp", "seen"), ("status", "status"))
    ])


def _roll_up(messages: Column) -> Column:
    has = lambda s: F.exists(messages, lambda m: m["status"] == s)
    return F.when(has("error"), "error").when(has("skipped"), "skipped").otherwise("success")


def _with_outcomes(df: DataFrame, outcomes: DataFrame | None) -> DataFrame:
    if outcomes is None:
        return df.withColumns({f"__{s}_error": F.lit(None).cast("string") for s in ("download", "insert")})
    failed = outcomes.groupBy(F.col("resource_id").alias("id")).agg(
        F.min(F.when(F.col("step") == "download", F.col("error"))).alias("__download_error"),
        F.min(F.when(F.col("step") == "insert", F.col("error"))).alias("__insert_error"),
    )
    return df.join(failed, "id", "left")


def stamp_run(report: DataFrame, start: str, end: str) -> DataFrame:
    """The report of a finished run, as it replaces the previous one."""
    return report.withColumns({"import_start": F.lit(start), "import_end": F.lit(end)})


def has_changed(catalog: DataFrame, state: DataFrame, step: str, environment: str = "prod") -> DataFrame:
    """The catalogue with ``changed`` true where the kept stamp differs or either is unknown."""
    seen = state.select("resource_key", F.col("timestamp").alias("__seen"))
    keyed = catalog.withColumn("resource_key", resource_key(step, environment))
    same = F.coalesce(F.col("__seen") == iso(F.col("last_changed")), F.lit(False))
    return keyed.join(seen, "resource_key", "left").withColumn("changed", ~same).drop("__seen")


def next_state(state: DataFrame, report: DataFrame, environment: str = "prod", names: Names = Names()) -> DataFrame:
    """The state after a run: steps that ran replace what was kept for the same resource.

    A failed download is kept with its message as status; a failed insert is not kept, so it is
    tried again. The report is read once, and each key keeps one row.
    """
    base = F.concat_ws("/", "org_name", "dataset_name", "resource_name", "resource_id")
    messages = F.from_json("messages", "array<struct<status string, text string>>")
    failure = F.get(F.filter(messages, lambda m: m["text"].startswith("while downloading, ")), F.lit(0))["text"]
    found = F.coalesce(F.regexp_replace(failure, "^while downloading, ", ""), F.lit("success"))
    inserted = (F.col("status") == "success") & ~F.col("step").isin("prepare", "no change, skipped")

    def kept(step: str, when: Column, status: Column) -> Column:
        key = F.concat_ws("/", base, F.lit(step), F.lit(environment))
        return F.when(when, F.struct(key.alias("resource_key"), F.col("last_changed").alias("timestamp"), status.alias("status")))

    ran = F.array(kept("download", F.col(names.target) != ARCHIVE, found), kept("insert", inserted, F.lit("success")))
    fresh = report.select(F.explode(F.array_compact(ran)).alias("s")).select("s.*", F.lit(0).alias("__age"))
    old = state.select("resource_key", "timestamp", "status", F.lit(1).alias("__age"))
    return first_per_key(fresh.unionByName(old), "resource_key", [F.col("__age")], {"__age"}).drop("__age")
