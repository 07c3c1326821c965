"""Queries that write tables or files from the given tables and read them back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff import session
from tablehandoff.functions import text
from tablehandoff.operators import assertions, contract, history, rows, snapshots
from tablehandoff.plans import jobs
from tablehandoff.registry.base import STG, Tables, query, staged
from tablehandoff.registry.delivery import COLUMNS, DATES, EXPORT_SQL, RUN_DATE
from tablehandoff.registry.versions import NEWEST
from tablehandoff.sinks import files as file_sinks
from tablehandoff.sinks import tables, versions
from tablehandoff.sources import files
from tablehandoff.sources.files import FixedColumn
from tablehandoff.streaming import landing

SCHEMA = "c_custkey BIGINT, c_name STRING, o_orderkey BIGINT, o_orderdate STRING, o_totalprice DOUBLE"
KEYS = ["c_custkey", "o_orderkey"]
TEXT_COLUMNS = ["c_custkey", "c_name", "o_orderkey", "o_orderdate"]


def extract(t: Tables, columns: list[str] = COLUMNS) -> DataFrame:
    return staged(t).select(*rows.export_columns(columns, DATES))


@query(EXPORT_SQL)
def upload_job(t: Tables) -> DataFrame:
    """A delivered json file loaded back into a staging table, twice as the same batch."""
    folder = session.work_folder(t.spark, "upload")
    paths = file_sinks.deliver_json(extract(t), f"{folder}/in", "orders.json", RUN_DATE, KEYS)

    def rules() -> list[contract.Rule]:
        return [contract.matches("o_orderdate", F.col("o_orderdate"), "^[0-9]{4}-[0-9]{2}-[0-9]{2}$")]

    for _ in range(2):
        loaded = jobs.run_upload(t.spark, paths, "json", SCHEMA, "orders", f"{folder}/t", "1", rules)
    return loaded


@query(EXPORT_SQL)
def stream_upload(t: Tables) -> DataFrame:
    """Delivered files picked up by a stream and loaded batch by batch."""
    folder = session.work_folder(t.spark, "stream")
    file_sinks.deliver_csv(
        extract(t), f"{folder}/in", "orders_{yyyymmdd}.csv", RUN_DATE, KEYS, rows_per_file=20_000
    )
    landing.watch_landing(t.spark, f"{folder}/in", "orders_")
    arrived = landing.landing_rows(t.spark, f"{folder}/in", "orders_", SCHEMA).drop("file_name")
    landing.stream_upload(arrived, f"{folder}/t", f"{folder}/c").awaitTermination()
    return t.spark.read.parquet(f"{folder}/t").drop("batch")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY event_id DESC) AS v FROM events) WHERE v = 1""")
def stream_latest(t: Tables) -> DataFrame:
    """The newest event per user, kept up to date by a stream over delivered files."""
    folder = session.work_folder(t.spark, "latest")
    events = t.events.select("user_id", "event_id", "event_type")
    file_sinks.deliver_csv(
        events, f"{folder}/in", "events.csv", RUN_DATE, ["event_id"], rows_per_file=50_000
    )
    schema = "user_id BIGINT, event_id BIGINT, event_type STRING"
    arrived = landing.landing_rows(t.spark, f"{folder}/in", "events", schema).drop("file_name")
    latest = landing.latest_per_branch(arrived, ["user_id"], ["event_id"])

    def merge(batch: DataFrame, _: int) -> None:
        keyed = batch.withColumn("part", F.pmod("user_id", F.lit(16)))
        tables.write_upsert(f"{folder}/t", keyed, ["part", "user_id"], ["event_id"], "part")

    (
        latest.writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
        .awaitTermination()
    )
    return t.spark.read.parquet(f"{folder}/t").drop("part")


@query(f"""WITH {STG}, f AS (SELECT '{",".join(TEXT_COLUMNS)}' || chr(10) || string_agg(
    c_custkey || ',' || c_name || ',' || o_orderkey || ',' || o_orderdate, chr(10) ORDER BY c_custkey, o_orderkey) AS b FROM stg)
SELECT 'out/first.csv' AS path, sha256(b) AS digest FROM f
UNION ALL SELECT 'out/second.csv', sha256(b) FROM f""")
def delivered_corpus(t: Tables) -> DataFrame:
    """The texts of two delivered files, read as a corpus."""
    folder = session.work_folder(t.spark, "corpus")
    for name in ("first.csv", "second.csv"):
        file_sinks.deliver_csv(extract(t, TEXT_COLUMNS), f"{folder}/out", name, RUN_DATE, KEYS)
    return files.read_corpus(t.spark, folder).select("path", F.sha2("text", 256).alias("digest"))


@query(f"""WITH {STG} SELECT 'out' AS top, 'out/orders.csv' AS rel_path, (sum(length(
    c_custkey || ',' || c_name || ',' || o_orderkey || ',' || o_orderdate) + 1)
    + length('{",".join(TEXT_COLUMNS)}') + 1)::BIGINT AS size FROM stg""")
def delivered_inventory(t: Tables) -> DataFrame:
    folder = session.work_folder(t.spark, "inventory")
    file_sinks.deliver_csv(extract(t, TEXT_COLUMNS), f"{folder}/out", "orders.csv", RUN_DATE, KEYS)
    return files.list_inventory(t.spark, folder, ["out"]).drop("mtime")


@query(f"""WITH {STG}, l AS (SELECT row_number() OVER (ORDER BY c_custkey, o_orderkey) + 1 AS line_no,
    c_custkey || ',' || c_name || ',' || o_orderkey || ',' || o_orderdate AS line FROM stg)
SELECT line_no, line FROM l WHERE line_no <= 20 UNION ALL SELECT 1, '{",".join(TEXT_COLUMNS)}'""")
def delivered_sample(t: Tables) -> DataFrame:
    """The first 20 lines of a delivered file, header included."""
    folder = session.work_folder(t.spark, "sample")
    paths = file_sinks.deliver_csv(extract(t, TEXT_COLUMNS), f"{folder}/out", "orders.csv", RUN_DATE, KEYS)
    head, _ = rows.sample_lines(files.file_lines(t.spark, paths))
    return head.select("line_no", "line")


@query(f"""WITH {STG} SELECT 'file exists' AS assertion, false AS passed, '1 files missing' AS detail
UNION ALL SELECT 'file is not empty', false, '1 empty files'
UNION ALL SELECT 'header matches the sample', false, '2 of 3 files differ'
UNION ALL SELECT 'parses as csv', count(*) = 0, count(*) || ' bad records' FROM stg WHERE c_mktsegment = 'BUILDING'""")
def default_checks(t: Tables) -> DataFrame:
    folder = session.work_folder(t.spark, "checks")
    good = extract(t)
    file_sinks.deliver_csv(good, f"{folder}/out", "orders.csv", RUN_DATE, KEYS)
    # Keys that are no numbers, for one segment, under another header.
    unread = F.when(F.col("c_mktsegment") == "BUILDING", "none").otherwise(F.col("c_custkey").cast("string"))
    other = extract(t, [*COLUMNS, "c_mktsegment"]).withColumn("c_custkey", unread)
    renamed = other.select(*COLUMNS).withColumnRenamed("c_custkey", "key")
    file_sinks.deliver_csv(renamed, f"{folder}/out", "other.csv", RUN_DATE, ["o_orderkey"])
    nothing = [FixedColumn("c_name", 30)]
    file_sinks.deliver_fixed(good.limit(0), nothing, f"{folder}/out", "empty.csv", RUN_DATE, ["c_name"])
    names = ["orders.csv", "other.csv", "empty.csv", "gone.csv"]
    return assertions.default_checks(t.spark, f"{folder}/out", names, "csv", SCHEMA, ",".join(COLUMNS))


HASHED = """'{prefix}' || sha256('{header}' || chr(10) || string_agg(c_custkey || ',' || c_name || ',' || o_orderkey || ',' || o_orderdate
  || chr(10), '' ORDER BY c_custkey, o_orderkey))""".format(prefix=text.HASH_PREFIX, header=",".join(TEXT_COLUMNS))


@query(f"""WITH {STG} SELECT 'orders_1.csv' AS name, {HASHED} AS hash FROM stg
UNION ALL SELECT 'orders_3.csv', {HASHED} FROM stg WHERE o_orderdate < '1995-06-01'""")
def skip_identical(t: Tables) -> DataFrame:
    """Three delivered files in two runs of a stream; the second has the content of the first."""
    folder = session.work_folder(t.spark, "identical")
    every = extract(t, TEXT_COLUMNS)
    early = every.where(F.col("o_orderdate") < "1995-06-01")
    for name, df in (("orders_1.csv", every), ("orders_2.csv", every), ("orders_3.csv", early)):
        file_sinks.deliver_csv(df, f"{folder}/in", name, RUN_DATE, KEYS)
        if name != "orders_1.csv":
            arrived = landing.landing_files(t.spark, f"{folder}/in", "orders_")
            landing.skip_identical(arrived, f"{folder}/t", f"{folder}/s", f"{folder}/c").awaitTermination()
    stored = t.spark.read.parquet(f"{folder}/t")
    return stored.select(F.element_at(F.split("path", "/"), -1).alias("name"), "hash")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS v FROM events) WHERE v = 1""")
def upsert_table(t: Tables) -> DataFrame:
    """A stored state updated partition by partition, the later half of the month first."""
    path = session.work_folder(t.spark, "state")
    events = t.events.select("user_id", "event_type", "ts", "event_id", "value")
    half = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    for part in (events.where(F.col("ts") >= half), events.where(F.col("ts") < half)):
        last = history.latest_per_key(part, ["event_type", "user_id"], NEWEST)
        tables.write_upsert(path, last, ["event_type", "user_id"], NEWEST, "event_type")
    return t.spark.read.parquet(path).drop("ts")


@query("""SELECT event_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN '1' ELSE '2' END AS batch FROM events""")
def history_table(t: Tables) -> DataFrame:
    """Two archived batches, the first one written twice."""
    path = session.work_folder(t.spark, "history")
    half = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    early, late = F.col("ts") < half, F.col("ts") >= half
    for batch, condition in (("1", early), ("2", late), ("1", early)):
        tables.append_history(t.events.where(condition), path, batch)
    stored = t.spark.read.parquet(path)
    return stored.select("event_id", "event_type", F.col("batch").cast("string").alias("batch"))


@query(f"""WITH {STG} SELECT c_mktsegment AS job_name, o_orderkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'again' ELSE 'first' END AS run FROM stg""")
def redeliver(t: Tables) -> DataFrame:
    """Every segment delivered, then one of them twice more."""
    path = session.work_folder(t.spark, "redeliver")
    rows_of = staged(t).select(F.col("c_mktsegment").alias("job_name"), "o_orderkey")
    tables.redeliver(rows_of.withColumn("run", F.lit("first")), path)
    one = rows_of.where(F.col("job_name") == "BUILDING").withColumn("run", F.lit("again"))
    for _ in range(2):
        tables.redeliver(one, path)
    return t.spark.read.parquet(path)


@query(f"""WITH {STG} SELECT 'first' AS step, count(*) > 0 AS written FROM stg UNION ALL SELECT 'same rows', false
UNION ALL SELECT 'one more row', true""")
def write_if_changed(t: Tables) -> DataFrame:
    """Whether each of three writes happened: new, unchanged in another order, changed."""
    folder = session.work_folder(t.spark, "materialize")
    table = extract(t)
    steps = {
        "first": table,
        "same rows": table.orderBy(F.desc("o_orderkey")),
        "one more row": table.unionByName(table.orderBy("o_orderkey").limit(1)),
    }
    written = []
    for step, df in steps.items():
        digest = snapshots.table_fingerprint(df)
        done = tables.materialize_if_changed(df, digest, f"{folder}/t")
        written.append((step, done))
    return t.spark.createDataFrame(written, "step string, written boolean")


@query(EXPORT_SQL)
def versioned_table(t: Tables) -> DataFrame:
    """The current rows of a table whose second version reads the first, and whose third was
    written but never published."""
    folder = session.work_folder(t.spark, "versions") + "/t"
    whole = extract(t)
    late = whole.where(F.col("o_orderdate") >= "1995-06-01")
    versions.replace(late, folder)
    early = whole.where(F.col("o_orderdate") < "1995-06-01")
    versions.replace(versions.read_current(t.spark, folder).unionByName(early), folder, "second")
    versions.write_version(late, folder)
    return versions.read_current(t.spark, folder)


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS v FROM events) WHERE v = 1""")
def upsert_parts(t: Tables) -> DataFrame:
    """The same state in parts of its partitions, updated by thirds of the month."""
    path = session.work_folder(t.spark, "parts")
    events = t.events.select("user_id", "event_type", "ts", "event_id", "value")
    days = F.day("ts")
    for part in (events.where(days > 20), events.where(days <= 10), events.where((days > 10) & (days <= 20))):
        tables.write_upsert(path, part, ["event_type", "user_id"], NEWEST, "event_type", parts=8)
    return tables.read_upsert(t.spark, path).drop("ts")
