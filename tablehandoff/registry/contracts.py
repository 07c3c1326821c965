"""Contract rules, referential checks, registries and overlays."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.functions import text
from tablehandoff.operators import assertions, contract, history, references, rows
from tablehandoff.plans import manifests
from tablehandoff.plans.decisions import quality_report as report_problems
from tablehandoff.registry.base import BIG_PRICE, Tables, big_orders, query

BIG = f"big AS (SELECT * FROM orders WHERE o_totalprice > {BIG_PRICE})"


def order_rules() -> list[contract.Rule]:
    return [
        contract.one_of("status", F.col("o_orderstatus"), ["F", "O"]),
        contract.matches("priority", F.col("o_orderpriority"), "^[1-3]-"),
    ]


@query("""SELECT o_orderkey, (o_orderstatus NOT IN ('F', 'O'))::BIGINT
    + (NOT regexp_matches(o_orderpriority, '^[1-3]-'))::BIGINT AS n_errors,
  concat_ws(' | ',
    CASE WHEN o_orderstatus NOT IN ('F', 'O')
      THEN 'status: ''' || o_orderstatus || ''' is not one of [''F'', ''O'']' END,
    CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-3]-')
      THEN 'priority: ''' || o_orderpriority || ''' does not match ^[1-3]-' END) AS errors
FROM orders""")
def check_rules(t: Tables) -> DataFrame:
    checked = contract.check_rules(t.orders, ["o_orderkey"], order_rules())
    return checked.select(
        "o_orderkey",
        F.size("errors").cast("long").alias("n_errors"),
        F.concat_ws(" | ", "errors").alias("errors"),
    )


@query("""SELECT c_custkey, concat_ws(' | ',
  CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
    THEN 'segment: ''' || c_mktsegment || ''' is not one of [''BUILDING'', ''MACHINERY'']' END,
  CASE WHEN c_acctbal < 0 THEN 'balance below zero' END) AS errors
FROM customer""")
def custom_checks(t: Tables) -> DataFrame:
    """A caller's vectorised row check behind the declared rules."""

    def overdrawn(batch: pd.DataFrame) -> pd.Series:
        return (batch["c_acctbal"] < 0).map({True: ["balance below zero"], False: []})

    checked = contract.check_with(
        t.customer, ["c_custkey"], ["c_acctbal"], overdrawn,
        [contract.one_of("segment", F.col("c_mktsegment"), ["BUILDING", "MACHINERY"])],
    )
    return checked.withColumn("errors", F.concat_ws(" | ", "errors"))


REPORT_SQL = f"""{BIG}, broken AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
report AS (
  SELECT c_custkey, 'error' AS severity, 'account overdrawn' AS message FROM broken
  UNION ALL
  SELECT o_custkey, 'error', 'priority: ''' || o_orderpriority || ''' does not match ^[1-3]-'
  FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-3]-')
    AND o_custkey NOT IN (SELECT c_custkey FROM broken)
  UNION ALL
  SELECT o_custkey, 'error', 'status: ''' || o_orderstatus || ''' is not one of [''F'', ''O'']'
  FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    AND o_custkey NOT IN (SELECT c_custkey FROM broken)
  UNION ALL
  SELECT c_custkey, 'warning', 'no large order' FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM big) AND c_acctbal >= 0)"""


def problems(t: Tables) -> DataFrame:
    broken = t.customer.where(F.col("c_acctbal") < 0).select(
        "c_custkey", F.lit("account overdrawn").alias("message")
    )
    checked = contract.check_rules(
        t.orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], order_rules()
    )
    idle = references.unreferenced(
        t.customer, big_orders(t).withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]
    ).select("c_custkey", F.lit("no large order").alias("message"))
    return report_problems("c_custkey", broken, [contract.error_rows(checked, ["c_custkey"])], [idle])


@query(f"WITH {REPORT_SQL} SELECT * FROM report")
def quality_report(t: Tables) -> DataFrame:
    return problems(t)


@query(f"""WITH {REPORT_SQL} SELECT c_custkey, count(*) FILTER (severity = 'error') AS errors,
  count(*) FILTER (severity = 'warning') AS warnings,
  count(*) FILTER (severity = 'error') = 0 AS ok FROM report GROUP BY 1""")
def error_summary(t: Tables) -> DataFrame:
    return assertions.error_summary(problems(t), ["c_custkey"])


@query("""WITH e AS (SELECT *, (props->>'$.k')::INT AS k FROM events)
SELECT event_id, event_type FROM e
WHERE (k < 50 AND NOT contains(event_type, 'error')) OR (event_type = 'error' AND value > 40)""")
def external_changes(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    folder = F.when(k < 50, F.lit("job/")).otherwise(F.lit("docs/"))
    changes = t.events.withColumn("paths", F.array(F.concat(folder, k.cast("string"))))
    by_hand = (F.col("event_type") == "error") & (F.col("value") > 40)
    kept = rows.external_changes(changes, "paths", "event_type", "job/", "error", by_hand)
    return kept.select("event_id", "event_type")


@query("""SELECT doc_id, concat_ws(' | ',
  CASE WHEN lang = 'en' AND NOT contains(upper(text), 'THE') THEN 'en output contains no THE' END,
  CASE WHEN lang = 'de' AND NOT contains(upper(text), 'UND') THEN 'de output contains no UND' END,
  CASE WHEN lang IN ('fr', 'es') AND NOT contains(text, 'des')
    THEN lang || ' output does not mention job_name ''des''' END) AS problems
FROM documents WHERE problems <> ''""")
def content_markers(t: Tables) -> DataFrame:
    found = contract.marker_problems(
        F.col("text"), F.col("lang"), {"en": "THE", "de": "UND"}, F.lit("des"), ["fr", "es"]
    )
    checked = t.documents.select("doc_id", F.concat_ws(" | ", found).alias("problems"))
    return checked.where(F.col("problems") != "")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_refs(t: Tables) -> DataFrame:
    return references.missing_refs(t.documents, t.labels, ["doc_id"])


@query(f"""WITH {BIG} SELECT c_custkey, c_name FROM customer
WHERE c_mktsegment <> 'MACHINERY' AND c_custkey NOT IN (SELECT o_custkey FROM big)""")
def unreferenced(t: Tables) -> DataFrame:
    refs = big_orders(t).withColumnRenamed("o_custkey", "c_custkey")
    found = references.unreferenced(
        t.customer, refs, ["c_custkey"], F.col("c_mktsegment") == "MACHINERY"
    )
    return found.select("c_custkey", "c_name")


@query(f"""WITH {BIG} SELECT c_custkey, count(o_orderkey) AS versions
FROM customer LEFT JOIN big ON c_custkey = o_custkey GROUP BY 1""")
def history_counts(t: Tables) -> DataFrame:
    made = big_orders(t).withColumnRenamed("o_custkey", "c_custkey")
    return history.history_counts(t.customer, made, ["c_custkey"])


@query("""SELECT o_orderkey, o_orderstatus AS name,
  (SELECT '[' || string_agg(DISTINCT '''' || l_linestatus || '''', ', ' ORDER BY '''' || l_linestatus || '''')
     || ']' FROM lineitem) AS known
FROM orders WHERE o_orderstatus NOT IN (SELECT DISTINCT l_linestatus FROM lineitem)""")
def unknown_keys(t: Tables) -> DataFrame:
    """Order statuses that are no line status; the line statuses are the registry."""
    used = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("name"))
    return references.unknown_keys(used, "name", t.lineitem, "l_linestatus", whole=True)


@query(f"""WITH {BIG}, set_names AS (
  SELECT c_name AS name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM big)
  UNION SELECT c_mktsegment FROM customer WHERE c_acctbal > 9900)
SELECT c_custkey, name FROM (
  SELECT c_custkey, c_name AS name FROM customer UNION ALL SELECT c_custkey, c_mktsegment FROM customer)
WHERE name NOT IN (SELECT name FROM set_names)""")
def unset_required(t: Tables) -> DataFrame:
    """Every customer declares an account and a segment name; some of them are set."""
    declared = F.create_map(F.lit("account"), "c_name", F.lit("segment"), "c_mktsegment")
    active = t.customer.join(
        big_orders(t).select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_semi"
    ).select(F.col("c_name").alias("name"))
    rich = t.customer.where(F.col("c_acctbal") > 9900).select(F.col("c_mktsegment").alias("name"))
    decls = t.customer.select("c_custkey", declared.alias("secrets"))
    found = references.unset_required(decls, "secrets", active.unionByName(rich))
    return found.select("c_custkey", "name")


@query(f"""WITH {BIG}, vip AS (SELECT DISTINCT o_custkey FROM big)
SELECT c_custkey, 'name' AS k, c_name AS v FROM customer
UNION ALL SELECT c_custkey, 'segment', CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE 'PREMIUM' END
  FROM customer LEFT JOIN vip ON c_custkey = o_custkey
UNION ALL SELECT o_custkey, 'tier', 'gold' FROM vip""")
def overlay(t: Tables) -> DataFrame:
    base = t.customer.select(
        "c_custkey",
        F.create_map(
            F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment",
            F.lit("secrets"), F.col("c_nationkey").cast("string"),
        ).alias("base"),
    )
    gold = F.create_map(F.lit("segment"), F.lit("PREMIUM"), F.lit("tier"), F.lit("gold"))
    override = (
        big_orders(t).select(F.col("o_custkey").alias("c_custkey")).distinct()
        .withColumn("override", gold)
    )
    merged = references.overlay(base, override, "c_custkey", "base", "override", ["secrets"])
    return merged.select("c_custkey", F.explode("merged").alias("k", "v"))


@query("""SELECT d.doc_id, coalesce(quality, -1) AS quality, quality IS NOT NULL AS overridden
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def override_or_default(t: Tables) -> DataFrame:
    return references.override_or_default(
        t.documents.select("doc_id"), t.labels, "doc_id", "quality", F.lit(-1)
    )


@query("""SELECT c_custkey, 'STG_' || upper(job) AS staging, 'int-' || replace(job, '_', '-') AS app,
  'int/' || job AS branch, '/api/' || job || '/' AS endpoint,
  'generated/tests/test_' || job || '.py' AS output
FROM (SELECT c_custkey, replace(lower(c_name), '#', '_') AS job FROM customer)""")
def derived_names(t: Tables) -> DataFrame:
    job = F.col("job")
    named = t.customer.select("c_custkey", F.translate(F.lower("c_name"), "#", "_").alias("job"))
    return named.select(
        "c_custkey",
        text.staging_table(job).alias("staging"),
        text.dashed_name(job, "int-").alias("app"),
        text.branch_name(job, "int/").alias("branch"),
        text.endpoint_path(job, "/api/").alias("endpoint"),
        text.output_path(job, "generated/tests/test_{job}.py").alias("output"),
    )


@query("""SELECT c_custkey, name, regexp_matches(name, '^[a-z][a-z0-9_]{2,40}$') AS valid FROM (
  SELECT c_custkey, replace(lower(trim(' ' || CASE WHEN c_acctbal < 0 THEN c_name
    ELSE replace(c_name, '#', '-') END || '  ')), '-', '_') AS name FROM customer)""")
def normalize_name(t: Tables) -> DataFrame:
    raw = F.concat(
        F.lit(" "),
        F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(F.translate("c_name", "#", "-")),
        F.lit("  "),
    )
    named = t.customer.select("c_custkey", text.normalize_name(raw).alias("name"))
    return named.withColumn("valid", text.valid_name(F.col("name")))


@query("""SELECT event_type, count(*) AS n,
  list_position(['signup', 'view', 'click', 'purchase', 'error'], event_type)::BIGINT AS ordinal
FROM events GROUP BY event_type""")
def canonical_order(t: Tables) -> DataFrame:
    counted = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return rows.canonical_order(
        counted, "event_type", ["signup", "view", "click", "purchase", "error"]
    )


# A manifest per customer. Broken names and modes follow from the balance and the segment,
# files exist for customers with a large order, and the others keep a forgotten one.
@query(f"""WITH {BIG}, c AS (SELECT *, c_custkey IN (SELECT o_custkey FROM big) AS active,
    CASE WHEN c_acctbal < 0 THEN c_name ELSE replace(lower(c_name), '#', '_') END AS job_name,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'yolo' ELSE 'deploy' END AS mode FROM customer),
invalid AS (
  SELECT c_custkey AS job, 'job_name: ''' || job_name || ''' does not match {text.NAME_PATTERN}' AS message
  FROM c WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey, 'mode: ''yolo'' is not one of [''deploy'', ''generate'']' FROM c WHERE mode = 'yolo'),
valid AS (SELECT * FROM c WHERE c_acctbal >= 0 AND mode <> 'yolo')
SELECT job, 'error' AS severity, message FROM invalid
UNION ALL SELECT c_custkey, 'error', 'manifest references job/sql/' || c_custkey || '.sql but that file does not exist'
  FROM valid WHERE NOT active
UNION ALL SELECT c_custkey, 'error', 'connection ''sftp_prod'' is not defined in the registry (known: '
  || '[''mule_dev'', ''oracle_dev'', ''sftp_dev''])' FROM valid WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, 'error', '{manifests.UNSET.format(name="ORACLE_DEV_PASSWORD")}' FROM valid
UNION ALL SELECT c_custkey, 'warning', 'job/specs/old.txt exists but is not referenced' FROM valid WHERE NOT active""")
def manifest_report(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    name = F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(
        F.translate(F.lower("c_name"), "#", "_")
    )
    load = F.struct(
        F.concat(F.lit("sql/"), key, F.lit(".sql")).alias("file"), F.lit("export").alias("role")
    )
    target = F.when(F.col("c_mktsegment") == "BUILDING", "sftp_prod").otherwise("sftp_dev")
    header = F.to_json(F.struct(
        name.alias("job_name"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "yolo").otherwise("deploy").alias("mode"),
        F.lit("download").alias("direction"),
        F.struct(F.array(load).alias("sql")).alias("sources"),
        F.struct(
            target.alias("connection"), F.lit("/in").alias("path"),
            F.lit("csv").alias("file_format"), F.lit("x.csv").alias("file_name_pattern"),
        ).alias("destination"),
    ))
    given = t.customer.select(F.col("c_custkey").alias("job"), header.alias("header"))
    given = given.withColumn("text", F.concat(F.lit("---\n"), "header", F.lit("\n---\n")))
    active = big_orders(t).select(F.col("o_custkey").alias("job")).distinct()
    idle = t.customer.select(F.col("c_custkey").alias("job")).join(active, "job", "left_anti")
    load_file = F.concat(F.lit("sql/"), F.col("job").cast("string"), F.lit(".sql"))
    files = active.select("job", load_file.alias("path")).unionByName(
        idle.select("job", F.lit("specs/old.txt").alias("path"))
    )
    registry = t.spark.createDataFrame(
        [("oracle_dev", {"user": "ORACLE_DEV_USER", "password": "ORACLE_DEV_PASSWORD"}),
         ("mule_dev", {}), ("sftp_dev", {})],
        "name string, secrets map<string,string>",
    )
    set_names = t.spark.createDataFrame([("ORACLE_DEV_USER",)], "name string")
    return manifests.manifest_report(given, files, registry, set_names)
