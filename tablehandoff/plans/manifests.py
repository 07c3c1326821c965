"""The checks of job manifests: one row per job, the manifest as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehandoff.functions import text
from tablehandoff.functions.state import TEXT, flatten_refs, struct_of
from tablehandoff.operators import contract, references
from tablehandoff.operators.snapshots import unpivot_fields
from tablehandoff.scale import broadcast_if_bounded
from tablehandoff.session import checkpoint_folder

_LIST = T.ArrayType(struct_of("file", "role"))
# The closed schema of a manifest.
MANIFEST = struct_of(
    "job_name",
    "mode",
    "direction",
    sources=struct_of(sql=_LIST, specs=_LIST, samples=_LIST, mappings=_LIST),
    destination=struct_of("connection", "path", "file_format", "file_name_pattern"),
    connections=struct_of("oracle", "mulesoft"),
    mulesoft_delivery=struct_of("repo", "branch"),
    testing=struct_of(
        "expected_row_logic",
        key_assertions=T.ArrayType(TEXT),
        expected_files=T.ArrayType(struct_of("file", "compare")),
    ),
)
# Enumerations, roles per source list, defaults.
MODES = ["generate", "deploy"]
DIRECTIONS = ["download", "upload"]
FORMATS = ["csv", "fixed", "json", "xml"]
ROLES = {
    "sql": ["staging_load", "export", "procedure"],
    "specs": ["business_rules"],
    "samples": ["output_example"],
    "mappings": ["field_mapping"],
}
DEFAULT_CONNECTIONS = {"oracle": "oracle_dev", "mulesoft": "mule_dev"}
# Messages.
UNSET = "Secret {name} not configured in repo Settings → Secrets → Actions"

KINDS = {"STRING": "a text", "OBJECT": "a mapping", "ARRAY": "a list"}
# Path, kind, may be null. What may not be left out has a rule of its own.
SHAPE = [
    ("job_name", "STRING", True),
    ("sources", "OBJECT", True),
    *[(f"sources.{n}", "ARRAY", False) for n in ROLES],
    ("destination", "OBJECT", False),
    *[(f"destination.{n}", "STRING", True) for n in ("connection", "path", "file_name_pattern")],
    ("connections", "OBJECT", False),
    *[(f"connections.{n}", "STRING", False) for n in ("oracle", "mulesoft")],
    ("mulesoft_delivery", "OBJECT", True),
    *[(f"mulesoft_delivery.{n}", "STRING", True) for n in ("repo", "branch")],
    ("testing", "OBJECT", True),
    ("testing.expected_row_logic", "STRING", True),
    ("testing.key_assertions", "ARRAY", False),
    ("testing.expected_files", "ARRAY", False),
]

_SOURCE_CATEGORY = {"sql": "sql", "specs": "specs", "samples": "samples", "mappings": "destination"}


def parse_manifests(df: DataFrame, header: str = "header") -> DataFrame:
    """(job, header, m, v): the parsed manifest struct, null for text that is not JSON, and
    the manifest as it is written."""
    parsed = F.from_json(header, MANIFEST)
    return df.withColumns({
        "m": F.when(F.json_object_keys(header).isNotNull(), parsed), "v": F.try_parse_json(header),
    })


def _m(path: str) -> Column:
    return F.col(f"m.{path}")


def _raw(path: str, kind: str = "variant") -> Column:
    """The value at a path as it is written, whatever its type; null if it is absent."""
    return F.try_variant_get("v", f"$.{path}", kind)


def _written_as(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def typed(path: str, kind: str, nullable: bool) -> contract.Rule:
    """A field that is there is of its kind (STRING, OBJECT or ARRAY); null only if ``nullable``."""
    allowed = [kind, "VOID"] if nullable else [kind]
    holds = F.coalesce(_written_as(_raw(path)).isin(allowed), F.lit(True))
    return contract.Rule(holds, F.lit(f"{path}: must be {KINDS[kind]}"))


def item_rules(path: str, texts: Sequence[str], allowed: Sequence[str]) -> list[contract.ListRule]:
    """Every item of a list is a mapping of the ``allowed`` fields, and ``texts`` are texts."""
    items = _raw(path, "array<variant>")
    fields = F.transform(items, lambda x: F.try_variant_get(x, "$", "map<string,variant>"))
    names = F.flatten(F.transform(F.array_compact(fields), F.map_keys))
    rules = [
        contract.no_unknown_fields(path, names, allowed),
        contract.ListRule(
            F.transform(items, _written_as),
            lambda kind: kind == "OBJECT",
            lambda _: F.lit(f"{path}: every item must be a mapping"),
        ),
    ]
    for name in texts:
        written = F.transform(
            F.array_compact(fields),
            lambda m: F.coalesce(_written_as(F.try_element_at(m, F.lit(name))), F.lit("VOID")),
        )
        rules.append(contract.ListRule(
            written,
            lambda kind: kind == "STRING",
            lambda kind: F.when(kind == "VOID", f"{path}: field {name} required").otherwise(
                f"{path}: {name} must be a text"
            ),
        ))
    return rules


def manifest_rules() -> list[contract.Rule | contract.ListRule]:
    rules: list[contract.Rule | contract.ListRule] = [
        contract.Rule(
            text.valid_name(_m("job_name")),
            F.concat(F.lit("job_name: '"), F.coalesce(_m("job_name"), F.lit("")),
                     F.lit(f"' does not match {text.NAME_PATTERN}")),
        ),
        contract.one_of("mode", _m("mode"), MODES),
        contract.one_of("direction", _m("direction"), DIRECTIONS),
        contract.required("sources", _m("sources")),
        contract.one_of("destination.file_format", _m("destination.file_format"), FORMATS),
    ]
    for name in ("connection", "path", "file_name_pattern"):
        rules.append(contract.required(f"destination.{name}", _m(f"destination.{name}")))
    for name, allowed in ROLES.items():
        rules.append(contract.roles(f"sources.{name}", _m(f"sources.{name}.role"), allowed))
    rules.append(contract.no_unknown_fields("manifest", F.json_object_keys("header"), MANIFEST.names))
    for parent in ("sources", "destination", "connections", "mulesoft_delivery", "testing"):
        keys = F.json_object_keys(F.get_json_object("header", f"$.{parent}"))
        rules.append(contract.no_unknown_fields(parent, keys, MANIFEST[parent].dataType.names))
    for path, kind, nullable in SHAPE:
        rules.append(typed(path, kind, nullable))
    for name in ROLES:  # a role that is missing or no text is an unknown role
        rules.extend(item_rules(f"sources.{name}", ["file"], ["file", "role"]))
    rules.extend(item_rules("testing.expected_files", ["file", "compare"], ["file", "compare"]))
    rules.append(contract.ListRule(
        F.transform(_raw("testing.key_assertions", "array<variant>"), _written_as),
        lambda kind: kind == "STRING",
        lambda _: F.lit("testing.key_assertions: every item must be a text"),
    ))
    return rules


def referenced_files(manifests: DataFrame) -> DataFrame:
    """(job, seq, path): source lists in their order, then the expected files."""
    lists = [F.col(f"m.sources.{n}.file") for n in ROLES] + [_m("testing.expected_files.file")]
    return manifests.select("job", F.posexplode(F.array_compact(flatten_refs(*lists))).alias("seq", "path"))


def reference_categories(manifests: DataFrame) -> DataFrame:
    """(job, path, category) of the files the source lists name."""
    def tagged(category: str):
        return lambda f: F.struct(f.alias("path"), F.lit(category).alias("category"))

    pairs = [
        F.transform(_m(f"sources.{n}.file"), tagged(c)) for n, c in _SOURCE_CATEGORY.items()
    ]
    return manifests.select("job", F.inline(flatten_refs(*pairs)))


def manifest_fields(manifests: DataFrame) -> DataFrame:
    """(job, field, value) with the source lists as separate fields."""
    fields = {n: _m(n) for n in MANIFEST.names if n != "sources"}
    fields |= {f"sources.{n}": _m(f"sources.{n}") for n in ROLES}
    return unpivot_fields(manifests, ["job"], fields)


def used_connections(manifests: DataFrame) -> DataFrame:
    """(job, name): connections a job uses, defaults filled in, each once.

    The source connection counts only for jobs that have load files.
    """
    source = F.coalesce(_m("connections.oracle"), F.lit(DEFAULT_CONNECTIONS["oracle"]))
    names = F.array(
        F.when(F.size(F.coalesce(_m("sources.sql.file"), F.array().cast("array<string>"))) > 0, source),
        F.coalesce(_m("connections.mulesoft"), F.lit(DEFAULT_CONNECTIONS["mulesoft"])),
        _m("destination.connection"),
    )
    return manifests.select(
        "job", F.explode(F.array_distinct(F.array_compact(names))).alias("name")
    )


def manifest_report(
    manifests: DataFrame,
    files: DataFrame,
    connections: DataFrame,
    set_names: DataFrame,
    registry_error: str | None = None,
) -> DataFrame:
    """(job, severity, message) over all jobs.

    manifests(job, text, header): text is null when the manifest is missing, header the
    JSON of its front matter · files(job, path) below the job · connections(name, secrets
    map role -> variable), the registry · set_names(name).

    ``registry_error`` says why the registry could not be read: every readable job gets it as
    one error in place of the checks of its connections; the other findings stay.
    """
    # Parsed and judged once per job; all schema errors of a manifest are listed, and they
    # stop its other checks.
    checkpoint_folder(manifests.sparkSession)
    unreadable = (
        F.when(F.col("text").isNull(), "manifest not found")
        .when(~text.has_front_matter(F.col("text")), "manifest has no front-matter block")
        .otherwise("front-matter is not a mapping")
    )
    judged = contract.check_rules(parse_manifests(manifests), ["job", "text", "m"], manifest_rules())
    errors = F.when(F.col("m").isNull(), F.array(unreadable)).otherwise(F.col("errors"))
    judged = judged.select("job", "m", errors.alias("errors")).checkpoint()
    broken = judged.select("job", F.explode("errors").alias("message"))
    stopped = judged.where(F.size("errors") > 0).select("job")
    parsed = judged.where(F.size("errors") == 0)
    refs = referenced_files(parsed).select("job", "path").distinct()
    absent = refs.join(files.select("job", "path").distinct(), ["job", "path"], "left_anti").select(
        "job",
        F.format_string("manifest references job/%s but that file does not exist", "path").alias(
            "message"
        ),
    )
    in_lists = F.split("path", "/")[0].isin([*ROLES])
    orphans = files.where(in_lists).join(stopped, "job", "left_anti").join(refs, ["job", "path"], "left_anti").select(
        "job", F.format_string("job/%s exists but is not referenced", "path").alias("message")
    )
    if registry_error is not None:
        unread = parsed.select("job", F.lit(registry_error).alias("message"))
        return _report([broken, absent, unread], orphans)
    used = used_connections(parsed)
    message = F.concat(F.lit("connection '"), "name", F.lit("' is not defined in the registry (known: "), "known", F.lit(")"))
    unknown = references.unknown_keys(used, "name", connections, whole=True).select(
        "job", message.alias("message")
    )
    head, tail = UNSET.split("{name}")
    declared = connections.select("name", F.explode(F.map_values("secrets")).alias("variable"))
    unset = declared.join(
        set_names.select(F.col("name").alias("variable")).distinct(), "variable", "left_anti"
    )
    # Most jobs share a few connections, and those are hot keys; the registry is bounded.
    unset = used.join(broadcast_if_bounded(unset)[0], "name").select(
        "job", F.concat(F.lit(head), "variable", F.lit(tail)).alias("message")
    )
    return _report([broken, absent, unknown, unset], orphans)


def _report(errors: Sequence[DataFrame], warnings: DataFrame) -> DataFrame:
    columns = ["job", "severity", "message"]
    out = warnings.withColumn("severity", F.lit("warning")).select(columns)
    for part in errors:
        out = out.unionByName(part.withColumn("severity", F.lit("error")).select(columns))
    return out
