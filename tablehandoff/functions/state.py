"""Nested job state kept as JSON text, and nested reference lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = T.StringType()


def struct_of(*names: str, **typed: T.DataType) -> T.StructType:
    """Struct of text fields followed by the typed ones."""
    fields = {**{n: TEXT for n in names}, **typed}
    return T.StructType([T.StructField(n, kind) for n, kind in fields.items()])


# The fields of a job's state and their defaults.
STATE_SCHEMA = T.StructType([
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("job_name", TEXT),
    T.StructField("last_run_id", TEXT),
    T.StructField("last_run_at", TEXT),
    T.StructField("last_mode", TEXT),
    T.StructField("input_hashes", T.MapType(TEXT, TEXT)),
    T.StructField("combined_input_hash", TEXT),
    T.StructField(
        "artifacts", T.MapType(TEXT, struct_of("path", "input_hash_at_gen", "generated_at"))
    ),
    T.StructField(
        "substages",
        T.MapType(
            TEXT, struct_of("status", "input_hash", "generated_at", "deployed_at", "test_result")
        ),
    ),
    T.StructField(
        "stage_history",
        T.MapType(
            TEXT,
            T.ArrayType(
                struct_of("generated_at", "input_hash", "artifact_path", "git_commit", "run_id",
                          "mode", "test_result")
            ),
        ),
    ),
    T.StructField("deployed", T.MapType(TEXT, TEXT)),
    T.StructField("last_test_result", T.MapType(TEXT, TEXT)),
])
SCHEMA_VERSION = 1


def _default(field: T.StructField) -> Column:
    kind = field.dataType
    if isinstance(kind, T.MapType):
        return F.from_json(F.lit("{}"), kind)
    if isinstance(kind, T.StringType):
        return F.lit("")
    return F.lit(None).cast(kind)


def read_state(
    c: Column,
    schema: T.StructType = STATE_SCHEMA,
    defaults: Mapping[str, Column] | None = None,
) -> Column:
    """Struct of the known fields with defaults, plus ``extras``: the unknown ones as text."""
    if defaults is None:
        defaults = {"schema_version": F.lit(SCHEMA_VERSION)} if schema is STATE_SCHEMA else {}
    parsed = F.from_json(c, schema)
    known = [
        F.coalesce(
            parsed[f.name], defaults[f.name] if f.name in defaults else _default(f)
        ).alias(f.name)
        for f in schema.fields
    ]
    names = [f.name for f in schema.fields]
    extras = F.map_filter(
        F.coalesce(
            F.from_json(c, T.MapType(T.StringType(), T.StringType())),
            F.from_json(F.lit("{}"), T.MapType(T.StringType(), T.StringType())),
        ),
        lambda k, _: ~k.isin(names),
    )
    return F.struct(*known, extras.alias("extras"))


def write_state(c: Column) -> Column:
    """JSON text of a state struct, nulls written out so that it reads back the same."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def flatten_refs(*lists: Column) -> Column:
    """All lists one after the other, each in its own order; null lists count as empty."""
    return F.flatten(F.array_compact(F.array(*lists)))
