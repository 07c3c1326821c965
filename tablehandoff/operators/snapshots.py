"""Fingerprints, snapshot differences and the routing of changes to outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.functions.text import HASH_PREFIX

# The outputs of a job, and which of them a changed category touches.
OUTPUTS = ["ords", "mulesoft", "tests"]
IMPACT = {
    "sql": ["ords", "tests"],
    "destination": ["mulesoft", "tests"],
    "specs": ["ords", "mulesoft", "tests"],
    "samples": ["mulesoft", "tests"],
    "testing": ["tests"],
    "identity": ["ords", "mulesoft", "tests"],
    "mode": [],
}

# Manifest field -> category; the source lists are separate fields.
FIELD_CATEGORY = {
    "job_name": "identity",
    "direction": "identity",
    "mode": "mode",
    "destination": "destination",
    "connections": "destination",
    "mulesoft_delivery": "destination",
    "testing": "testing",
    "sources.sql": "sql",
    "sources.specs": "specs",
    "sources.samples": "samples",
    "sources.mappings": "destination",
}

# Top directory -> category, for paths nothing refers to any more.
DIRECTORY_CATEGORY = {
    "tests": "testing",
    "sql": "sql",
    "specs": "specs",
    "samples": "samples",
    "mappings": "destination",
}
# Order in which a referenced path is looked up; the first match wins.
CATEGORY_RANK = ["sql", "specs", "samples", "destination"]
UNKNOWN_CATEGORY = "specs"  # unknown change: everything is affected

EXACT, SUM, TREE = "exact", "sum", "tree"
PIECE = 6  # hex digits of a row digest that are added up together
# Hex digits that the rows below a leaf, and the leaves below a branch, have in common: up to
# 4096 leaves in a branch, and 4096 branches in a group.
LEAF_DIGITS, BRANCH_DIGITS = 6, 3


def _literal_map(pairs: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _exact_digest(key: Column, value: Column) -> Column:
    """sha256 over ``key NUL hash NUL`` of all rows in key order."""
    rows = F.array_sort(F.collect_list(F.struct(key.alias("k"), value.alias("h"))))
    fed = F.transform(rows, lambda r: F.concat(r.k, F.lit("\0"), r.h, F.lit("\0")))
    return F.concat(F.lit(HASH_PREFIX), F.sha2(F.array_join(fed, ""), 256))


def _with_digest(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.withColumn("_row", F.sha2(F.concat(key, F.lit("\0"), value, F.lit("\0")), 256))


def _sum_limbs() -> list[Column]:
    """Sums of the pieces of every row's digest: they combine in any order.

    Pieces of 24 bits leave room for 5e11 rows of one group in a 64-bit sum; beyond that
    the sum raises an overflow error.
    """
    pieces = [F.conv(F.substring("_row", at, PIECE), 16, 10) for at in range(1, 65, PIECE)]
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(p.cast("long")).alias(f"_s{i}") for i, p in enumerate(pieces)],
    ]


def _sum_digest() -> Column:
    sums = [F.coalesce(f"_s{i}", F.lit(0)).cast("string") for i in range(len(range(1, 65, PIECE)))]
    joined = F.concat_ws(":", F.col("n").cast("string"), *sums)
    return F.concat(F.lit(HASH_PREFIX), F.sha2(joined, 256))


def _tree_node(rows: DataFrame, groups: Sequence[str], digits: int, entry: Column) -> DataFrame:
    """One row for each common start of ``_row``: the digest of the sorted entries below it."""
    fed = F.array_join(F.array_sort(F.collect_list(entry)), "")
    start = F.left("_row", F.lit(digits)).alias("_row")
    return rows.groupBy(*groups, start).agg(F.sum("n").alias("n"), F.sha2(fed, 256).alias("_digest"))


def _tree(df: DataFrame, groups: Sequence[str], key: Column, value: Column) -> DataFrame:
    """Digests of the rows, of the leaves, of the branches, of the group.

    The place of a row in the tree follows from its digest alone, so neither order nor
    partitions matter. Copies of a row are counted before they meet, and a leaf holds a
    16-millionth of the distinct rows of its group, so a hot group uses every task.
    """
    cells = [F.concat(F.coalesce(c, F.lit("\1")), F.lit("\0")) for c in (key, value)]
    counted = df.groupBy(*groups, F.sha2(F.concat(*cells), 256).alias("_row")).agg(F.count(F.lit(1)).alias("n"))
    copies = F.concat("_row", F.lit(":"), F.col("n").cast("string"), F.lit(";"))
    below = F.concat("_row", F.lit(":"), "_digest", F.lit(";"))
    leaves = _tree_node(counted, groups, LEAF_DIGITS, copies)
    branches = _tree_node(leaves, groups, BRANCH_DIGITS, below)
    return _tree_node(branches, groups, 0, below)


def fingerprint(
    df: DataFrame,
    groups: Sequence[str],
    key: str,
    value: str,
    form: str,
) -> DataFrame:
    """(groups, n, form, fingerprint): a digest per group that ignores row order.

    ``EXACT`` is the digest of the sorted rows of a group, which must fit a task: the files
    of a job. ``TREE`` is a digest of digests: as hard to forge, and for groups of any size.
    ``SUM`` is the digest of the row count and of the added row digests; it combines on the
    map side. The caller picks the form, so digests stored for a group stay comparable however
    it grows. In a tree a null key or value is one of its own, not an empty one.
    """
    k, v = F.col(key).cast("string"), F.col(value)
    if form == EXACT:
        return df.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("n"),
            F.lit(EXACT).alias("form"),
            _exact_digest(k, v).alias("fingerprint"),
        )
    if form == TREE:
        root = F.concat(F.lit(HASH_PREFIX), F.col("_digest")).alias("fingerprint")
        return _tree(df, groups, k, v).select(*groups, "n", F.lit(TREE).alias("form"), root)
    if form != SUM:
        raise ValueError(f"form is {EXACT!r}, {TREE!r} or {SUM!r}, not {form!r}")
    sums = _with_digest(df, k, v).groupBy(*groups).agg(*_sum_limbs())
    return sums.select(*groups, "n", F.lit(SUM).alias("form"), _sum_digest().alias("fingerprint"))


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """One digest of a whole table (rows in any order, copies counted), in the sum form."""
    names = list(columns or df.columns)
    whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    rows = _with_digest(df, F.lit(",".join(names)), whole)
    return rows.agg(*_sum_limbs()).select(_sum_digest()).first()[0]


def _both_sides(
    old: DataFrame, new: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """One row per key with the value and the presence on each side.

    A union and an aggregate rather than a full outer join: it combines on the map side,
    a hot key cannot multiply rows, and null values stay apart from absent keys.
    """
    sides = old.select(*keys, F.col(value).alias("_v"), F.lit(False).alias("_new")).unionByName(
        new.select(*keys, F.col(value).alias("_v"), F.lit(True).alias("_new"))
    )
    is_new = F.col("_new")
    return sides.groupBy(*keys).agg(
        F.max(F.when(~is_new, F.col("_v"))).alias("old_value"),
        F.max(F.when(is_new, F.col("_v"))).alias("new_value"),
        F.bool_or(~is_new).alias("_in_old"),
        F.bool_or(is_new).alias("_in_new"),
    )


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """(keys, change) with change added, removed or modified; unchanged keys are left out."""
    both = _both_sides(old, new, keys, value)
    change = (
        F.when(~F.col("_in_old"), "added")
        .when(~F.col("_in_new"), "removed")
        .when(~F.col("old_value").eqNullSafe(F.col("new_value")), "modified")
    )
    return both.select(*keys, change.alias("change")).where(F.col("change").isNotNull())


def key_union(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.select(*keys).unionByName(new.select(*keys)).distinct()


def unpivot_fields(df: DataFrame, keys: Sequence[str], fields: Mapping[str, Column]) -> DataFrame:
    """(keys, field, value): one row per field, the value as JSON text, null if missing."""
    cells = [
        F.struct(F.lit(n).alias("field"), F.to_json(F.struct(c.alias("v"))).alias("value"))
        for n, c in fields.items()
    ]
    exploded = df.select(*keys, F.explode(F.array(*cells)).alias("_f"))
    return exploded.select(*keys, "_f.field", "_f.value")


def fields_changed(
    old: DataFrame, new: DataFrame, keys: Sequence[str],
    category: Mapping[str, str] | None = None,
) -> DataFrame:
    """(keys, field[, category]) of the fields that differ; a missing field equals null.

    Both sides are (keys, field, value). A null value is written by ``unpivot_fields`` as
    an empty object, and a missing row counts the same.
    """
    both = _both_sides(old, new, [*keys, "field"], "value")
    empty = F.lit("{}")
    differs = F.coalesce("old_value", empty) != F.coalesce("new_value", empty)
    out = both.where(differs).select(*keys, "field")
    if category is None:
        return out
    return out.withColumn("category", F.element_at(_literal_map(category), F.col("field")))


def classify(
    paths: DataFrame, refs: DataFrame, keys: Sequence[str], path: str = "path"
) -> DataFrame:
    """Adds ``category`` to every path; the first match wins.

    1. a reference of the current manifest (refs: keys, path, category) in the order
       sql, specs, samples, destination; 2. the top directory; 3. the unknown category.
    """
    ranks = F.array(*[F.lit(c) for c in CATEGORY_RANK])
    referenced = refs.groupBy(*keys, path).agg(
        F.min_by("category", F.array_position(ranks, F.col("category"))).alias("_category")
    )
    top = F.split(F.col(path), "/")
    by_directory = F.element_at(_literal_map(DIRECTORY_CATEGORY), top[0])
    # A bare file name is no directory, except for the source lists themselves.
    by_directory = F.when((F.size(top) == 1) & (top[0] == "tests"), None).otherwise(by_directory)
    return (
        paths.join(referenced, [*keys, path], "left")
        .withColumn(
            "category", F.coalesce("_category", by_directory, F.lit(UNKNOWN_CATEGORY))
        )
        .drop("_category")
    )


def impact_items(category: Column, impact: Mapping[str, Sequence[str]] = IMPACT) -> Column:
    """The outputs a category affects, from the fixed dimension; unknown categories: none."""
    cases = [F.lit(c) for c in impact]
    lists = [
        F.array(*[F.lit(i) for i in items]).cast("array<string>") for items in impact.values()
    ]
    table = F.map_from_arrays(F.array(*cases), F.array(*lists))
    return F.coalesce(F.element_at(table, category), F.array().cast("array<string>"))


def impact_join(
    categories: DataFrame,
    category: str = "category",
    impact: Mapping[str, Sequence[str]] = IMPACT,
    item: str = "item",
) -> DataFrame:
    """One row per category row and affected output."""
    return categories.withColumn(item, F.explode(impact_items(F.col(category), impact)))


def affected_set(rows: DataFrame, groups: Sequence[str], item: str = "item") -> DataFrame:
    """(groups, items): sorted affected outputs; at most as many as there are outputs."""
    return rows.groupBy(*groups).agg(F.array_sort(F.collect_set(item)).alias("items"))


def applicable(affected: Column, allowed: Column) -> Column:
    return F.array_sort(F.array_intersect(affected, allowed))


def skipped(every: Column, affected: Column) -> Column:
    return F.array_sort(F.array_except(every, affected))
