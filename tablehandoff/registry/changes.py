"""Fingerprints, snapshot differences, routing and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff import session
from tablehandoff.functions import text
from tablehandoff.operators import assertions, snapshots
from tablehandoff.plans import decisions
from tablehandoff.sinks import snapshots as stored
from tablehandoff.registry.base import (
    SNAPSHOTS,
    SQL_DIR,
    SQL_JOB,
    Tables,
    current_documents,
    document_path,
    document_refs,
    job_name,
    previous_documents,
    query,
)

# What the SQL sides share: changed documents with their category, then affected items.
CHANGES = f"""{SNAPSHOTS},
diff AS (
  SELECT coalesce(cur.doc_id, prev.doc_id) AS doc_id,
    CASE WHEN prev.doc_id IS NULL THEN 'added' WHEN cur.doc_id IS NULL THEN 'removed'
         ELSE 'modified' END AS change
  FROM cur FULL JOIN prev ON cur.doc_id = prev.doc_id WHERE cur.h IS DISTINCT FROM prev.h),
classified AS (
  SELECT diff.doc_id, {SQL_JOB} AS job, {SQL_DIR} || '/' || diff.doc_id AS path, change,
    CASE WHEN toxic = 1 THEN 'specs' WHEN quality = 1 THEN 'samples'
      WHEN d.lang = 'en' THEN 'sql' WHEN d.lang = 'de' THEN 'destination'
      WHEN d.lang = 'es' THEN 'testing' ELSE 'specs' END AS category
  FROM diff JOIN documents d ON d.doc_id = diff.doc_id LEFT JOIN labels l ON l.doc_id = diff.doc_id),
impact(category, item) AS (VALUES ('sql', 'ords'), ('sql', 'tests'), ('destination', 'mulesoft'),
  ('destination', 'tests'), ('specs', 'ords'), ('specs', 'mulesoft'), ('specs', 'tests'),
  ('samples', 'mulesoft'), ('samples', 'tests'), ('testing', 'tests')),
routed AS (SELECT job, string_agg(DISTINCT item, ',' ORDER BY item) AS items,
    list_sort(list(DISTINCT item)) AS l
  FROM classified JOIN impact USING (category) GROUP BY job)"""


def classified(t: Tables) -> DataFrame:
    changes = snapshots.snapshot_diff(
        previous_documents(t), current_documents(t), ["job", "path"], "hash"
    )
    return snapshots.classify(changes, document_refs(t), ["job"])


def routed(t: Tables) -> DataFrame:
    return snapshots.affected_set(snapshots.impact_join(classified(t)), ["job"])


@query(f"WITH {CHANGES} SELECT * FROM diff")
def snapshot_diff(t: Tables) -> DataFrame:
    return snapshots.snapshot_diff(previous_documents(t), current_documents(t), ["doc_id"], "hash")


@query(f"WITH {SNAPSHOTS} SELECT doc_id FROM cur UNION SELECT doc_id FROM prev")
def key_union(t: Tables) -> DataFrame:
    return snapshots.key_union(previous_documents(t), current_documents(t), ["doc_id"])


@query(f"WITH {CHANGES} SELECT job, path, change, category FROM classified")
def classify_paths(t: Tables) -> DataFrame:
    return classified(t)


@query(f"""WITH {SNAPSHOTS}, both_sides AS (
  SELECT coalesce(cur.doc_id, prev.doc_id) AS doc_id, cur.h AS h1, prev.h AS h2, cur.source AS s1,
    prev.source AS s2, cur.lang AS l1, prev.lang AS l2
  FROM cur FULL JOIN prev ON cur.doc_id = prev.doc_id)
SELECT doc_id, 'hash' AS field FROM both_sides WHERE h1 IS DISTINCT FROM h2
UNION ALL SELECT doc_id, 'source' FROM both_sides WHERE s1 IS DISTINCT FROM s2
UNION ALL SELECT doc_id, 'lang' FROM both_sides WHERE l1 IS DISTINCT FROM l2""")
def fields_changed(t: Tables) -> DataFrame:
    fields = {n: F.col(n) for n in ("hash", "source", "lang")}
    old = snapshots.unpivot_fields(previous_documents(t), ["doc_id"], fields)
    new = snapshots.unpivot_fields(current_documents(t), ["doc_id"], fields)
    return snapshots.fields_changed(old, new, ["doc_id"])


def stored_documents(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Both snapshots of the documents as bucketed tables."""
    folder = session.work_folder(t.spark, "snapshots")
    name = folder.rsplit("-", 1)[-1]
    fields = {n: F.col(n) for n in ("hash", "source", "lang")}
    sides = (("prev", previous_documents(t)), ("cur", current_documents(t)))
    old, new = (
        stored.write_snapshot(df, f"{side}_{name}", f"{folder}/{side}", ["doc_id"], fields) for side, df in sides
    )
    return old, new


@query(f"""WITH {SNAPSHOTS} SELECT coalesce(cur.doc_id, prev.doc_id) AS doc_id,
  CASE WHEN prev.doc_id IS NULL THEN 'added' WHEN cur.doc_id IS NULL THEN 'removed' ELSE 'modified' END AS change
FROM cur FULL JOIN prev ON cur.doc_id = prev.doc_id
WHERE cur.h IS DISTINCT FROM prev.h OR cur.source IS DISTINCT FROM prev.source OR cur.lang IS DISTINCT FROM prev.lang""")
def stored_snapshot_diff(t: Tables) -> DataFrame:
    """The same difference between two stored snapshots, over all their fields."""
    return stored.compare_snapshots(*stored_documents(t), ["doc_id"])


@query(f"""WITH {SNAPSHOTS}, f AS (
  SELECT doc_id, unnest(['hash', 'source', 'lang']) AS field, unnest([h, source, lang]) AS v, true AS new FROM cur
  UNION ALL SELECT doc_id, unnest(['hash', 'source', 'lang']), unnest([h, source, lang]), false FROM prev),
b AS (SELECT doc_id, field, max(v) FILTER (NOT new) AS o, max(v) FILTER (new) AS n FROM f GROUP BY ALL)
SELECT doc_id, field, CASE WHEN o IS NULL THEN '{{}}' ELSE '{{"v":' || to_json(o) || '}}' END AS old_value,
  CASE WHEN n IS NULL THEN '{{}}' ELSE '{{"v":' || to_json(n) || '}}' END AS new_value
FROM b WHERE o IS DISTINCT FROM n""")
def stored_fields_changed(t: Tables) -> DataFrame:
    """Fields that differ between two stored snapshots, with both values."""
    return stored.compare_fields(*stored_documents(t), ["doc_id"])


@query(f"WITH {CHANGES} SELECT job, items FROM routed")
def impact_route(t: Tables) -> DataFrame:
    return routed(t).withColumn("items", F.concat_ws(",", "items"))


SQL_ALLOWED = """CASE WHEN job LIKE '%/en/%' OR job LIKE '%/fr/%' THEN ['mulesoft', 'ords', 'tests']
  ELSE ['mulesoft', 'tests'] END"""


def allowed_items() -> Column:
    everything = F.array(*[F.lit(i) for i in snapshots.OUTPUTS])
    without_load = F.array(*[F.lit(i) for i in snapshots.OUTPUTS if i != "ords"])
    return F.when(F.col("job").rlike("/(en|fr)/"), everything).otherwise(without_load)


@query(f"""WITH {CHANGES} SELECT job, array_to_string(
  list_filter({SQL_ALLOWED}, lambda x: list_contains(l, x)), ',') AS items FROM routed""")
def applicable_set(t: Tables) -> DataFrame:
    found = snapshots.applicable(F.col("items"), allowed_items())
    return routed(t).select("job", F.concat_ws(",", found).alias("items"))


@query(f"""WITH {CHANGES} SELECT job, array_to_string(
  list_filter(['mulesoft', 'ords', 'tests'], lambda x: NOT list_contains(l, x)), ',') AS items FROM routed""")
def skipped_set(t: Tables) -> DataFrame:
    every = F.array(*[F.lit(i) for i in snapshots.OUTPUTS])
    return routed(t).select(
        "job", F.concat_ws(",", snapshots.skipped(every, F.col("items"))).alias("items")
    )


# Outputs exist for jobs that had a good document; the
# number of bad documents stands for the testing block of the manifest.
AFFECTED = f"""{CHANGES},
jobs AS (SELECT job, bool_and(job NOT IN (SELECT job FROM prev)) AS first_run FROM cur GROUP BY job),
low AS (SELECT job, (SELECT count(*) FROM prev p WHERE p.job = j.job AND p.lang IS NULL) AS n_old,
    (SELECT count(*) FROM cur c JOIN labels l ON l.doc_id = c.doc_id
      WHERE c.job = j.job AND quality = 0) AS n_new FROM jobs j),
hits AS (SELECT DISTINCT job, item, category FROM (
    SELECT job, category FROM classified
    UNION ALL SELECT job, 'testing' FROM low WHERE n_old <> n_new) JOIN impact USING (category)),
reasoned AS (
  SELECT job, item, first_run,
    item <> 'ords' OR job LIKE '%/en/%' OR job LIKE '%/fr/%' AS applicable,
    (SELECT string_agg(category, ',' ORDER BY category) FROM hits h
      WHERE h.job = j.job AND h.item = i.item) AS cats,
    job IN (SELECT job FROM prev WHERE lang IS NOT NULL) AS recorded
  FROM jobs j, (VALUES ('ords'), ('mulesoft'), ('tests')) i(item)),
affected AS (
  SELECT job, item,
    CASE WHEN NOT applicable THEN 'not applicable'
      WHEN first_run OR cats IS NOT NULL OR NOT recorded THEN 'stale' ELSE 'current' END AS state,
    CASE WHEN NOT applicable THEN '' WHEN first_run THEN 'first run'
      ELSE concat_ws(',', cats, CASE WHEN NOT recorded THEN 'no output' END) END AS reasons
  FROM reasoned)"""


def affected(t: Tables) -> DataFrame:
    cur, prev = current_documents(t), previous_documents(t)
    known = prev.select("job").distinct().withColumn("_known", F.lit(True))
    jobs = (
        cur.select("job").distinct().join(known, "job", "left")
        .select("job", F.col("_known").isNull().alias("first_run"))
    )
    outputs = F.array(*[F.lit(i) for i in snapshots.OUTPUTS])
    records = (
        prev.where(F.col("quality") == 1).select("job").distinct()
        .select("job", F.explode(outputs).alias("item"))
    )
    low = t.labels.where(F.col("quality") == 0).select("doc_id")
    count = F.to_json(F.struct(F.count(F.lit(1)).alias("v"))).alias("value")
    testing = F.lit("testing").alias("field")
    old_fields = prev.where(F.col("quality") == 0).groupBy("job", testing).agg(count)
    new_fields = (
        cur.select("doc_id", "job").join(low, "doc_id", "left_semi").groupBy("job", testing).agg(count)
    )
    return decisions.affected_outputs(
        jobs,
        jobs.select("job", F.explode(allowed_items()).alias("item")),
        records,
        prev, cur,
        document_refs(t),
        old_fields, new_fields,
    )


@query(f"WITH {AFFECTED} SELECT * FROM affected")
def affected_outputs(t: Tables) -> DataFrame:
    return affected(t).withColumn("reasons", F.concat_ws(",", "reasons"))


@query(f"""WITH {AFFECTED}, m AS (SELECT *, job LIKE '%/es/%' OR job LIKE '%/fr/%' AS deploy FROM affected)
SELECT job, item,
  CASE WHEN state = 'not applicable' THEN 'skip'
    WHEN item = 'ords' THEN if(state = 'stale', 'generate', 'skip')
    WHEN item = 'mulesoft' THEN if(state <> 'stale', 'skip',
      if(job LIKE '%/de/%', 'workspace-edit', 'generate-new-flow'))
    ELSE if(deploy, 'run-tests', if(state = 'stale', 'generate', 'skip')) END AS action,
  CASE WHEN state = 'not applicable' THEN 'not applicable to this job'
    WHEN item = 'ords' THEN if(state = 'stale', 'load inputs changed or first run', 'load inputs unchanged')
    WHEN item = 'mulesoft' THEN if(state <> 'stale', 'delivery inputs unchanged',
      if(job LIKE '%/de/%', 'target is set: edit the existing flow', 'no target named: new flow'))
    WHEN deploy THEN if(state = 'stale', 'deploy mode: inputs changed, renew and run', 'deploy mode: always run')
    ELSE if(state = 'stale', 'test inputs changed', 'test inputs unchanged') END AS reason
FROM m""")
def label_actions(t: Tables) -> DataFrame:
    rules = decisions.plan_rules(
        F.col("item"), F.col("state"), F.col("job").rlike("/(es|fr)/"), F.contains("job", F.lit("/de/"))
    )
    return decisions.label_actions(affected(t), ["job", "item"], rules)


@query("""SELECT source, count(*) AS n, 'exact' AS form,
  'sha256:' || sha256(string_agg(doc_id::VARCHAR || chr(0) || sha256(text) || chr(0), ''
    ORDER BY doc_id::VARCHAR)) AS fingerprint
FROM documents GROUP BY source""")
def fingerprint_exact(t: Tables) -> DataFrame:
    hashed = t.documents.withColumn("h", F.sha2("text", 256))
    return snapshots.fingerprint(hashed, ["source"], "doc_id", "h", snapshots.EXACT)


LIMBS = ", ".join(
    f"sum(('0x' || substr(h, {at}, 6))::BIGINT)::VARCHAR AS s{i}" for i, at in enumerate(range(1, 65, 6))
)


@query(f"""WITH d AS (SELECT source, sha256(doc_id::VARCHAR || chr(0) || sha256(text) || chr(0)) AS h
  FROM documents),
s AS (SELECT source, count(*) AS n, {LIMBS} FROM d GROUP BY source)
SELECT source, n, 'sum' AS form,
  'sha256:' || sha256(concat_ws(':', n::VARCHAR, {", ".join(f"s{i}" for i in range(11))})) AS fingerprint FROM s""")
def fingerprint_sum(t: Tables) -> DataFrame:
    """The form for groups of any size."""
    hashed = t.documents.withColumn("h", F.sha2("text", 256))
    return snapshots.fingerprint(hashed, ["source"], "doc_id", "h", snapshots.SUM)


@query("""WITH d AS (SELECT source, sha256(doc_id::VARCHAR || chr(0) || sha256(text) || chr(0)) AS h, count(*) AS n
  FROM documents GROUP BY ALL),
leaf AS (SELECT source, h[1:6] AS p, sum(n) AS n, sha256(string_agg(h || ':' || n || ';', '' ORDER BY h)) AS x
  FROM d GROUP BY ALL),
branch AS (SELECT source, p[1:3] AS p, sum(n) AS n, sha256(string_agg(p || ':' || x || ';', '' ORDER BY p)) AS x
  FROM leaf GROUP BY ALL)
SELECT source, sum(n)::BIGINT AS n, 'tree' AS form,
  'sha256:' || sha256(string_agg(p || ':' || x || ';', '' ORDER BY p)) AS fingerprint FROM branch GROUP BY source""")
def fingerprint_tree(t: Tables) -> DataFrame:
    """The exact form for groups of any size: a digest of digests."""
    hashed = t.documents.select("source", "doc_id", F.sha2("text", 256).alias("h"))
    return snapshots.fingerprint(hashed, ["source"], "doc_id", "h", snapshots.TREE)


@query("SELECT doc_id, 'sha256:' || sha256(text) AS hash FROM documents")
def content_hash(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.content_hash(F.col("text")).alias("hash"))


@query(f"""SELECT {SQL_JOB} AS job,
  bool_or(coalesce(toxic, 0) = 1 OR length(text) > 8000) AS confident
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1""")
def confidence_flag(t: Tables) -> DataFrame:
    """Toxic labels stand for written assertions, long documents for test files."""
    docs = t.documents.select("doc_id", job_name().alias("job"), F.length("text").alias("chars"))
    asserted = docs.join(t.labels.where(F.col("toxic") == 1), "doc_id", "left_semi")
    long = docs.where(F.col("chars") > text.FILE_CHAR_CAP)
    return assertions.confidence_flag(docs.select("job").distinct(), asserted, long)


@query(f"""SELECT {SQL_JOB} AS job, bool_and(length(text) <= 8000) AS passed FROM documents GROUP BY 1""")
def verdict(t: Tables) -> DataFrame:
    """A text over the cap fails its job; French texts have no result."""
    result = F.when(text.over_cap(F.col("text")), "fail").when(F.col("lang") == "fr", "").otherwise("pass")
    return assertions.verdict(t.documents.select(job_name().alias("job"), result.alias("result")), ["job"])


@query("""WITH e AS (SELECT event_id, CASE WHEN value < 2 THEN '  ' WHEN event_type = 'click'
    THEN 'R100' || chr(9) || 'old/' || event_id || chr(9) || 'new/' || event_id
    WHEN event_type = 'error' THEN 'D' || chr(9) || 'gone/' || event_id
    ELSE upper(event_type[1]) || chr(9) || event_type || '/' || event_id END AS line FROM events)
SELECT event_id, line[1] AS status, str_split(line, chr(9))[-1] AS path,
  CASE WHEN len(str_split(line, chr(9))) > 2 THEN str_split(line, chr(9))[2] END AS old_path
FROM e WHERE trim(line) <> '' AND line[1] <> 'D'""")
def change_log(t: Tables) -> DataFrame:
    from tablehandoff.operators import rows

    key, kind = F.col("event_id").cast("string"), F.col("event_type")
    line = (
        F.when(F.col("value") < 2, F.lit("  "))
        .when(kind == "click", F.concat(F.lit("R100\told/"), key, F.lit("\tnew/"), key))
        .when(kind == "error", F.concat(F.lit("D\tgone/"), key))
        .otherwise(F.concat(F.upper(F.left(kind, F.lit(1))), F.lit("\t"), kind, F.lit("/"), key))
    )
    log = rows.parse_change_log(t.events.select("event_id", line.alias("line")), "line", "event_id")
    return rows.drop_deletes(log)


@query(f"""SELECT doc_id, {SQL_DIR} || '/' || doc_id AS path FROM documents d
WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND d.lang <> 'es'""")
def unreferenced_paths(t: Tables) -> DataFrame:
    """Files no manifest names; everything below tests/ is exempt."""
    from tablehandoff.operators import references

    paths = t.documents.select("doc_id", "lang", document_path().alias("path"))
    found = references.unreferenced(paths, t.labels, ["doc_id"], F.col("path").startswith("tests/"))
    return found.select("doc_id", "path")


def digests_sql(table: str, name: str) -> str:
    return f"""SELECT job, sha256(string_agg(doc_id::VARCHAR || chr(0) || h || chr(0), ''
    ORDER BY doc_id::VARCHAR)) AS {name} FROM {table} GROUP BY job"""


@query(f"""WITH {AFFECTED}, built AS ({digests_sql("cur", "b")}), delivered AS ({digests_sql("prev", "d")})
SELECT job, item FROM affected LEFT JOIN built USING (job) LEFT JOIN delivered USING (job)
WHERE (job LIKE '%/es/%' OR job LIKE '%/en/%') AND state <> 'not applicable' AND b IS NOT NULL
  AND b IS DISTINCT FROM d""")
def deliveries_due(t: Tables) -> DataFrame:
    """Outputs to deliver: the built content differs from what was delivered before."""

    def prints(docs: DataFrame, name: str) -> DataFrame:
        found = snapshots.fingerprint(docs, ["job"], "doc_id", "hash", snapshots.SUM)
        return found.select("job", F.col("fingerprint").alias(name))

    outputs = (
        affected(t)
        .join(prints(current_documents(t), "built"), "job", "left")
        .join(prints(previous_documents(t), "delivered"), "job", "left")
    )
    due = decisions.needs_delivery(
        F.col("state"), F.col("job").rlike("/(es|en)/"), F.col("built"), F.col("delivered")
    )
    return outputs.where(due).select("job", "item")
