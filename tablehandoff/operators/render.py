"""Files rendered by a caller's function."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.scale import running_total


def render_with(
    df: DataFrame,
    render: Callable[[list[dict]], bytes],
    file_key: str,
    order_by: Sequence[str],
    *,
    rows_per_part: int,
) -> DataFrame:
    """(file_key, part, content): ``render(rows) -> bytes`` per part of a file, rows sorted.

    Every file is cut into numbered parts of ``rows_per_part`` rows and ``render`` is called
    once for each part, so a header it writes stands in each. No task holds more than a
    part. ``order_by`` must be unique inside a file.
    """
    placed = running_total(df, [file_key], order_by, F.lit(1), "_before", rows_per_part)
    parts = placed.withColumn("part", F.floor(F.col("_before") / rows_per_part).cast("long"))
    columns = [c for c in df.columns if c != file_key]
    order = list(order_by)

    def one_file(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(order, kind="stable")[columns]
        content = render(ordered.to_dict("records"))
        return pd.DataFrame({file_key: [key[0]], "part": [key[1]], "content": [content]})

    schema = df.select(file_key).schema.add("part", "long").add("content", "binary")
    return parts.drop("_before").groupBy(file_key, "part").applyInPandas(one_file, schema)
