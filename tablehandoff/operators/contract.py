"""Contract rules: every problem of a row is reported, not only the first."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehandoff.functions import text


def _none() -> Column:
    return F.array().cast("array<string>")


def _if(broken: Column, message: Column) -> Column:
    """The message as a list, or an empty list; stays inside generated code."""
    return F.when(broken, F.array(message)).otherwise(_none())


@dataclass(frozen=True)
class Rule:
    """``holds`` must be true; null counts as broken. ``message`` may use the row."""

    holds: Column
    message: Column

    @property
    def problems(self) -> Column:
        return _if(~F.coalesce(self.holds, F.lit(False)), self.message)


@dataclass(frozen=True)
class ListRule:
    """Every element of ``values`` must satisfy ``holds``; one message per element."""

    values: Column
    holds: Callable[[Column], Column]
    message: Callable[[Column], Column]

    @property
    def problems(self) -> Column:
        bad = F.filter(
            F.coalesce(self.values, _none()),
            lambda x: ~F.coalesce(self.holds(x), F.lit(False)),
        )
        return F.transform(bad, self.message)


def _shown(c: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(c.cast("string"), F.lit("")), F.lit("'"))


def required(name: str, c: Column) -> Rule:
    return Rule(c.isNotNull(), F.lit(f"{name}: field required"))


def matches(name: str, c: Column, pattern: str) -> Rule:
    message = F.concat(F.lit(f"{name}: "), _shown(c), F.lit(f" does not match {pattern}"))
    return Rule(c.rlike(pattern), message)


def one_of(name: str, c: Column, allowed: Sequence[str]) -> Rule:
    names = ", ".join(f"'{a}'" for a in sorted(allowed))
    message = F.concat(F.lit(f"{name}: "), _shown(c), F.lit(f" is not one of [{names}]"))
    return Rule(c.isin(list(allowed)), message)


def roles(name: str, c: Column, allowed: Sequence[str]) -> ListRule:
    names = ", ".join(f"'{a}'" for a in sorted(allowed))
    return ListRule(
        c,
        lambda role: role.isin(list(allowed)),
        lambda role: F.concat(
            F.lit(f"{name}: unknown role "), _shown(role), F.lit(f" — allowed roles here: [{names}]")
        ),
    )


def no_unknown_fields(name: str, fields: Column, allowed: Sequence[str]) -> ListRule:
    """``fields`` holds the names present in the row; names outside ``allowed`` are errors."""
    return ListRule(
        fields,
        lambda f: f.isin(list(allowed)),
        lambda f: F.concat(F.lit(f"{name}: unknown field "), _shown(f)),
    )


def check_rules(
    df: DataFrame, keys: Sequence[str], rules: Sequence[Rule | ListRule], name: str = "errors"
) -> DataFrame:
    """(keys, errors[]) for every row, in rule order; a narrow projection without shuffle."""
    problems = F.concat(*[r.problems for r in rules])
    return df.select(*keys, problems.alias(name))


def error_rows(checked: DataFrame, keys: Sequence[str], name: str = "errors") -> DataFrame:
    return checked.select(*keys, F.explode(name).alias("message"))


def check_with(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    validate: Callable,
    rules: Sequence[Rule | ListRule] = (),
    name: str = "errors",
) -> DataFrame:
    """``check_rules`` plus a caller's row check.

    ``validate`` takes a pandas frame of ``columns`` and returns a series of lists of
    messages; its messages follow those of ``rules``.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def custom(batch: pd.DataFrame) -> pd.Series:
        return validate(batch)

    ruled = [r.problems for r in rules]
    extra = custom(F.struct(*columns))
    return df.select(*keys, F.concat(*ruled, extra).alias(name))


def marker_problems(
    content: Column,
    kind: Column,
    markers: Mapping[str, str],
    job: Column,
    named_kinds: Sequence[str] = (),
) -> Column:
    """Messages for content without its kind's marker or without the job's name.

    The marker is looked for in the upper-cased text, the job name as it is written.
    """
    upper = F.upper(content)
    checks = [
        _if((kind == k) & ~F.contains(upper, F.lit(m)), F.lit(f"{k} output contains no {m}"))
        for k, m in markers.items()
    ]
    if named_kinds:
        checks.append(
            _if(
                kind.isin(list(named_kinds)) & ~F.contains(content, job),
                F.concat(kind, F.lit(" output does not mention job_name "), _shown(job)),
            )
        )
    return F.concat(*checks)


def cap_problem(name: Column, content: Column, cap: int = text.FILE_CHAR_CAP) -> Column:
    """A message when the text is strictly over the cap; it is never cut."""
    message = F.concat(
        name, F.lit(": content is "), F.length(content).cast("string"),
        F.lit(f" chars, over the {cap}-char cap"),
    )
    return F.when(text.over_cap(content, cap), message)
