"""Texts assembled from the rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.functions import text
from tablehandoff.scale import heavy_groups, running_total, split_heavy

BLOCK_BREAK = "\n\n"
# Order of the section groups, form of a section, message of the cap.
SECTION_ORDER = ["sql", "specs", "samples", "mappings"]


def _joined(order: Sequence[str], block: str, sep: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(*order, block)))
    return F.array_join(F.transform(rows, lambda r: r[block]), sep)


def concat_corpus(
    df: DataFrame,
    groups: Sequence[str],
    path: str,
    content: str,
    order_by: Sequence[str] | None = None,
    *,
    part_chars: int,
) -> DataFrame:
    """(groups, part, blocks, text): ``### path`` blocks in order, a blank line between.

    Texts are stripped and empty ones dropped. In every group a block belongs to part
    ``characters of the blocks before it / part_chars``, rounded down, so no task holds
    more than a part and one text. The parts in order, with a blank line between, are the
    whole corpus.
    """
    order = list(order_by or [path])
    blocks = (
        df.select(*groups, *order, F.col(path).cast("string").alias("_path"),
                  text.strip(F.col(content)).alias("_text"))
        .where(F.col("_text") != "")
        .select(*groups, *order,
                F.concat(F.lit("### "), "_path", F.lit(BLOCK_BREAK), "_text").alias("_block"))
    )
    heavy = heavy_groups(blocks, groups, part_chars, weight=F.length("_block"))
    light, parts = blocks, None
    if heavy is not None:
        light, hot = split_heavy(blocks, groups, heavy)
        before = running_total(hot, groups, order, F.length("_block"), "_before")
        parts = before.withColumn("part", F.floor(F.col("_before") / part_chars)).drop("_before")
    rows = light.withColumn("part", F.lit(0).cast("long"))
    if parts is not None:
        rows = rows.unionByName(parts)
    return rows.groupBy(*groups, "part").agg(
        F.count(F.lit(1)).alias("blocks"),
        _joined(order, "_block", BLOCK_BREAK).alias("text"),
    )


def section(title: Column, content: Column) -> Column:
    return F.concat(F.lit("\n## "), title, F.lit("\n```\n"), content, F.lit("\n```"))


def group_sections(
    df: DataFrame,
    keys: Sequence[str],
    kind: str,
    seq: str,
    title: str,
    content: str,
    order: Sequence[str] = SECTION_ORDER,
    cap: int = text.TOTAL_CHAR_CAP,
) -> DataFrame:
    """(keys, sections, chars, text, problem): the labelled sections of an item, by kind
    in the fixed order and then by ``seq``.

    An item strictly over the cap is a problem and gets no text: it is never cut. The
    size is added up first, so an item over the cap is not assembled either. A section
    whose kind is not in ``order`` is a problem too: the item names the first such kind
    and gets no text.
    """
    kinds = F.array(*[F.lit(k) for k in order])
    place = F.coalesce(F.array_position(kinds, F.col(kind)), F.lit(0))
    unlisted = F.when(place == 0, F.coalesce(F.col(kind).cast("string"), F.lit("null")))
    parts = df.select(
        *keys,
        place.alias("_kind"),
        F.col(seq).alias("_seq"),
        section(F.col(title), F.col(content)).alias("_block"),
        unlisted.alias("_unlisted"),
    )
    # A line break stands between two sections.
    weight = F.length("_block") + 1
    heavy = heavy_groups(parts, keys, cap + 1, weight=weight)
    fitting = parts if heavy is None else split_heavy(parts, keys, heavy)[0]
    out = fitting.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sections"),
        (F.sum(weight) - 1).alias("chars"),
        _joined(["_kind", "_seq"], "_block", "\n").alias("text"),
        F.min("_unlisted").alias("_unlisted"),
    )
    out = out.select(
        *keys, "sections", "chars",
        F.when(F.col("_unlisted").isNull(), F.col("text")).alias("text"),
        F.concat(F.lit("unlisted section kind: "), "_unlisted").alias("problem"),
    )
    if heavy is None:
        return out
    over = (
        split_heavy(parts, keys, heavy)[1]
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("sections"), (F.sum(weight) - 1).alias("chars"))
        .withColumn("text", F.lit(None).cast("string"))
        .withColumn(
            "problem",
            F.concat(F.lit("assembled text is "), F.col("chars").cast("string"),
                     F.lit(f" chars, over the {cap}-char cap")),
        )
    )
    return out.unionByName(over)
