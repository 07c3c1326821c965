"""Referential checks in both directions, registries, overlays and overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.scale import anti_join

# Names of a registry that a short message lists, and that go into a plan as one literal.
REGISTRY_NAMES = 1_000


def missing_refs(refs: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """References whose target is absent, each once."""
    return refs.select(*keys).distinct().join(present.select(*keys).distinct(), list(keys), "left_anti")


def unreferenced(
    present: DataFrame, refs: DataFrame, keys: Sequence[str], exempt: Column | None = None
) -> DataFrame:
    """Targets nothing refers to; rows for which ``exempt`` holds are never reported."""
    if exempt is not None:
        present = present.where(~F.coalesce(exempt, F.lit(False)))
    return anti_join(present, refs.select(*keys).distinct(), keys)


def known_names(df: DataFrame, name: str, whole: bool = False) -> str | DataFrame:
    """The sorted names of a registry as text, for messages: all of them if ``whole``, else the
    first ``REGISTRY_NAMES``, and how many there are in all if that is not all. More names than
    that, all listed, are a table of one row."""
    names = df.select(F.col(name).alias("name")).where(F.col(name).isNotNull()).distinct()
    first = [r.name for r in names.orderBy("name").limit(REGISTRY_NAMES + 1).collect()]
    listed = ", ".join(f"'{n}'" for n in first[:REGISTRY_NAMES])
    if len(first) <= REGISTRY_NAMES:
        return f"[{listed}]"
    return _all_listed(names) if whole else f"[{listed}, ... {names.count()} names in all]"


def _all_listed(names: DataFrame) -> DataFrame:
    """One row: all the names, quoted, in order and in brackets, as one text.

    Each range of names becomes a text first, so no task holds all names one by one; the
    ranges are ordered by their first names. Only the text itself has to fit a row.
    """
    quoted = F.transform(
        F.sort_array(F.collect_list("name")),
        lambda n: F.concat(F.lit("'"), n.cast("string"), F.lit("'")),
    )
    ranges = (
        names.repartitionByRange("name")
        .withColumn("_run", F.spark_partition_id())
        .groupBy("_run")
        .agg(F.min("name").alias("first"), F.array_join(quoted, ", ").alias("text"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("first", "text")))
    joined = F.array_join(F.transform(ordered, lambda r: r["text"]), ", ")
    return ranges.agg(F.concat(F.lit("["), joined, F.lit("]")))


def unknown_keys(
    used: DataFrame, name: str, registry: DataFrame, key: str = "name", whole: bool = False
) -> DataFrame:
    """Used rows whose name is not in the registry, a table of any size, with the known names
    in ``known``, all of them if ``whole``. A null name is no use of a name. Each known name
    goes into the join once, so one that fills the registry does not fill a task."""
    listed = known_names(registry, key, whole)
    known = registry.select(F.col(key).alias(name)).distinct()
    unknown = anti_join(used.where(F.col(name).isNotNull()), known, [name])
    if isinstance(listed, str):
        return unknown.withColumn("known", F.lit(listed))
    # The join leaves all uses of one unknown name in one task, and each now gets a long text.
    tasks = int(used.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return unknown.repartition(tasks).withColumn("known", listed.scalar())


def unset_required(
    decls: DataFrame, declared: str, set_names: DataFrame, name: str = "name"
) -> DataFrame:
    """Names declared in a map column that are not set; a set but empty value is set.

    ``set_names`` has the names only, so no value can reach the result.
    """
    rest = [c for c in decls.columns if c != declared]
    wanted = decls.select(*rest, F.explode(F.map_values(declared)).alias(name))
    return anti_join(wanted, set_names.select(name).distinct(), [name])


def merge_maps(base: Column, override: Column, without: Sequence[str] = ()) -> Column:
    """One map with the entries of both, the override's value for a common name."""
    # A missing base has no entries: the override counts alone. Both missing give null.
    old = F.coalesce(base, F.map_filter(override, lambda k, v: F.lit(False)))
    new = F.coalesce(override, F.map_filter(base, lambda k, v: F.lit(False)))
    overridden = F.map_keys(new)
    kept = F.map_filter(
        old,
        lambda k, v: ~F.array_contains(overridden, k) & ~k.isin(list(without)),
    )
    return F.map_concat(kept, new)


def overlay(
    base: DataFrame,
    override: DataFrame,
    key: str,
    base_map: str,
    override_map: str,
    without: Sequence[str] = (),
    name: str = "merged",
) -> DataFrame:
    """(key, merged): base entries (minus some names) with the override's on top."""
    both = base.join(override, key, "left")
    return both.select(
        key, merge_maps(F.col(base_map), F.col(override_map), without).alias(name)
    )


def override_or_default(
    names: DataFrame, override: DataFrame, key: str, value: str, default: Column
) -> DataFrame:
    """Adds ``value`` (the override's, else the default) and ``overridden``.

    ``override`` has one row per key.
    """
    marked = override.select(key, F.col(value).alias("_value"), F.lit(True).alias("_set"))
    joined = names.join(marked, key, "left")
    found = F.coalesce("_set", F.lit(False))
    return joined.select(
        *names.columns,
        F.when(found, F.col("_value")).otherwise(default).alias(value),
        found.alias("overridden"),
    )
