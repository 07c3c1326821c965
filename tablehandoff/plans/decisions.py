"""Decisions over all jobs at once: what is stale, what to do, what is wrong."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.operators import snapshots
from tablehandoff.scale import anti_join, broadcast_if_bounded

STALE, CURRENT, NOT_APPLICABLE = "stale", "current", "not applicable"
FIRST_RUN, NO_OUTPUT = "first run", "no output"


def affected_outputs(
    jobs: DataFrame,
    applicable: DataFrame,
    records: DataFrame,
    old_hashes: DataFrame,
    new_hashes: DataFrame,
    refs: DataFrame,
    old_fields: DataFrame | None = None,
    new_fields: DataFrame | None = None,
    manifest_path: str | None = None,
    outputs: Sequence[str] = snapshots.OUTPUTS,
    impact: Mapping[str, Sequence[str]] = snapshots.IMPACT,
) -> DataFrame:
    """(job, item, state, reasons) for every job and output.

    jobs(job, first_run) · applicable(job, item) · records(job, item): outputs recorded
    and present · old/new_hashes(job, path, hash) · refs(job, path, category) ·
    old/new_fields(job, field, value).

    A first run makes every applicable output stale. Otherwise an output is stale when a
    changed field or file affects it, or when it has no record. The manifest itself is
    routed field by field, so its path is left out of the file comparison.
    """
    changes = snapshots.snapshot_diff(old_hashes, new_hashes, ["job", "path"], "hash")
    if manifest_path is not None:
        changes = changes.where(F.col("path") != manifest_path)
    categories = snapshots.classify(changes, refs, ["job"]).select("job", "category")
    if old_fields is not None and new_fields is not None:
        categories = categories.unionByName(
            snapshots.fields_changed(
                old_fields, new_fields, ["job"], snapshots.FIELD_CATEGORY
            ).select("job", "category")
        )
    hits = snapshots.impact_join(categories.distinct(), impact=impact)
    none = F.lit(None).cast("string")
    facts = (
        hits.select("job", "item", F.lit("hit").alias("fact"), "category")
        .unionByName(
            applicable.select("job", "item", F.lit("applicable").alias("fact"), none.alias("category"))
        )
        .unionByName(
            records.select("job", "item", F.lit("record").alias("fact"), none.alias("category"))
        )
        .groupBy("job", "item")
        .agg(
            F.bool_or(F.col("fact") == "applicable").alias("_applicable"),
            F.bool_or(F.col("fact") == "record").alias("_record"),
            F.array_sort(F.collect_set("category")).alias("_categories"),
        )
    )
    every = jobs.select(
        "job", "first_run", F.explode(F.array(*[F.lit(o) for o in outputs])).alias("item")
    ).join(facts, ["job", "item"], "left")
    no_record = ~F.coalesce("_record", F.lit(False))
    found = F.coalesce("_categories", F.array().cast("array<string>"))
    reasons = (
        F.when(~F.coalesce("_applicable", F.lit(False)), F.array().cast("array<string>"))
        .when(F.col("first_run"), F.array(F.lit(FIRST_RUN)))
        .otherwise(F.concat(found, F.array_compact(F.array(F.when(no_record, F.lit(NO_OUTPUT))))))
    )
    state = (
        F.when(~F.coalesce("_applicable", F.lit(False)), NOT_APPLICABLE)
        .when(F.size("reasons") > 0, STALE)
        .otherwise(CURRENT)
    )
    return every.withColumn("reasons", reasons).select(
        "job", "item", state.alias("state"), "reasons"
    )


@dataclass(frozen=True)
class ActionRule:
    when: Column
    action: str
    reason: str


def label_actions(rows: DataFrame, keys: Sequence[str], rules: Sequence[ActionRule]) -> DataFrame:
    """(keys, action, reason) of the first rule that holds; no rule gives nulls."""
    picked = F.coalesce(*[
        F.when(r.when, F.struct(F.lit(r.action).alias("action"), F.lit(r.reason).alias("reason")))
        for r in rules
    ])
    return rows.select(*keys, picked.alias("_p")).select(*keys, "_p.action", "_p.reason")


def plan_rules(
    item: Column, state: Column, deploy: Column, has_target: Column
) -> list[ActionRule]:
    """What to do with each output of a job, first match wins."""
    stale, n_a = state == STALE, state == NOT_APPLICABLE
    load, delivery, tests = item == "ords", item == "mulesoft", item == "tests"
    return [
        ActionRule(n_a, "skip", "not applicable to this job"),
        ActionRule(load & stale, "generate", "load inputs changed or first run"),
        ActionRule(load, "skip", "load inputs unchanged"),
        ActionRule(delivery & ~stale, "skip", "delivery inputs unchanged"),
        ActionRule(delivery & has_target, "workspace-edit", "target is set: edit the existing flow"),
        ActionRule(delivery, "generate-new-flow", "no target named: new flow"),
        ActionRule(tests & deploy & stale, "run-tests", "deploy mode: inputs changed, renew and run"),
        ActionRule(tests & deploy, "run-tests", "deploy mode: always run"),
        ActionRule(tests & stale, "generate", "test inputs changed"),
        ActionRule(tests, "skip", "test inputs unchanged"),
    ]


def needs_delivery(state: Column, deploy: Column, built: Column, delivered: Column) -> Column:
    """Deliver in deploy mode whenever what was built is not what was delivered last.

    Built and delivered state are separate, so switching a job to deploy after its
    outputs were built still delivers them.
    """
    return deploy & (state != NOT_APPLICABLE) & built.isNotNull() & ~built.eqNullSafe(delivered)


def record_built(
    affected: DataFrame, fingerprints: DataFrame, built: DataFrame
) -> DataFrame:
    """(job, item, fingerprint) after building the stale outputs in ``built`` (job, item).

    The fingerprint is kept per output: building one output does not make the other
    stale ones look current.
    """
    done = affected.join(built.select("job", "item").distinct(), ["job", "item"], "left_semi")
    return done.select("job", "item").join(fingerprints.select("job", "fingerprint"), "job")


def quality_report(
    key: str, broken: DataFrame, errors: Sequence[DataFrame], warnings: Sequence[DataFrame] = ()
) -> DataFrame:
    """(key, severity, message): all problems of all jobs.

    ``broken`` (key, message) are jobs that could not be read; their one error stops the
    other checks for them. ``errors`` and ``warnings`` are (key, message).
    """
    out = broken.select(key, F.lit("error").alias("severity"), "message")
    stopped, small = broadcast_if_bounded(broken.select(key).distinct())
    for severity, parts in (("error", errors), ("warning", warnings)):
        for part in parts:
            kept = part.join(stopped, key, "left_anti") if small else anti_join(part, stopped, [key])
            out = out.unionByName(kept.select(key, F.lit(severity).alias("severity"), "message"))
    return out
