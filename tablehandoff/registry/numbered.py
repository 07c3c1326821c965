"""Deliveries as numbered files, written and read back by many tasks of several files each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff import session
from tablehandoff.functions import text
from tablehandoff.operators import assertions, rows
from tablehandoff.plans import jobs
from tablehandoff.registry.base import STG, Tables, query
from tablehandoff.registry.delivery import COLUMNS, EXPORT_SQL, RUN_DATE
from tablehandoff.registry.tables import KEYS, SCHEMA, TEXT_COLUMNS, extract
from tablehandoff.sinks import files as file_sinks
from tablehandoff.sinks import versions
from tablehandoff.sources import files
from tablehandoff.streaming import landing

# Rows of a file: some files already at the smallest scale.
ROWS_PER_FILE = 500
HEADER = ",".join(TEXT_COLUMNS)
LINE = "c_custkey || ',' || c_name || ',' || o_orderkey || ',' || o_orderdate"


def delivered(t: Tables, folder: str, name: str = "orders.csv", df: DataFrame | None = None) -> list[str]:
    df = extract(t, TEXT_COLUMNS) if df is None else df
    return file_sinks.deliver_csv(df, folder, name, RUN_DATE, KEYS, rows_per_file=ROWS_PER_FILE)


@query(EXPORT_SQL)
def upload_numbered(t: Tables) -> DataFrame:
    """Numbered json files loaded into a staging table."""
    folder = session.work_folder(t.spark, "upload")
    paths = file_sinks.deliver_json(
        extract(t), f"{folder}/in", "orders.json", RUN_DATE, KEYS, rows_per_file=ROWS_PER_FILE
    )
    return jobs.run_upload(t.spark, paths, "json", SCHEMA, "orders", f"{folder}/t", "1")


@query(f"WITH {STG} SELECT {LINE} AS line FROM stg")
def corpus_numbered(t: Tables) -> DataFrame:
    """The lines of numbered files, read as a corpus."""
    folder = session.work_folder(t.spark, "corpus")
    delivered(t, f"{folder}/out")
    texts = files.read_corpus(t.spark, folder).select(F.explode(text.lines(F.col("text"))).alias("line"))
    return texts.where(F.col("line") != HEADER)


@query(f"""WITH {STG} SELECT 'out' AS top, (sum(length({LINE}) + 1))::BIGINT AS size FROM stg""")
def inventory_numbered(t: Tables) -> DataFrame:
    """The bytes of numbered files without their headers, from a listing."""
    folder = session.work_folder(t.spark, "inventory")
    delivered(t, f"{folder}/out")
    listed = files.list_inventory(t.spark, folder, ["out"])
    return listed.groupBy("top").agg(F.sum(F.col("size") - (len(HEADER) + 1)).alias("size"))


@query(f"""WITH {STG}, l AS (SELECT row_number() OVER (ORDER BY c_custkey, o_orderkey) + 1 AS line_no, {LINE} AS line FROM stg)
SELECT line_no, line FROM l WHERE line_no <= 20 UNION ALL SELECT 1, '{HEADER}'""")
def sample_numbered(t: Tables) -> DataFrame:
    """The first 20 lines of the first of several files."""
    folder = session.work_folder(t.spark, "sample")
    paths = delivered(t, f"{folder}/out")
    head, _ = rows.sample_lines(files.file_lines(t.spark, paths))
    return head.where(F.col("file") == "orders-00000.csv").select("line_no", "line")


@query(f"""WITH {STG} SELECT 'file exists' AS assertion, true AS passed, '0 files missing' AS detail
UNION ALL SELECT 'file is not empty', true, '0 empty files'
UNION ALL SELECT 'header matches the sample', true, '0 of ' || ceil(count(*) / {ROWS_PER_FILE}.0)::BIGINT || ' files differ' FROM stg
UNION ALL SELECT 'parses as csv', false, count(*) || ' bad records' FROM stg WHERE c_mktsegment = 'BUILDING'""")
def checks_numbered(t: Tables) -> DataFrame:
    """Default checks of numbered files; the keys of one segment are no numbers."""
    folder = session.work_folder(t.spark, "checks")
    unread = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("x"), "c_custkey")).otherwise(F.col("c_custkey").cast("string"))
    broken = extract(t, [*COLUMNS, "c_mktsegment"]).withColumn("c_custkey", unread).select(*COLUMNS)
    paths = delivered(t, f"{folder}/out", df=broken)
    names = [p.rsplit("/", 1)[-1] for p in paths]
    return assertions.default_checks(t.spark, f"{folder}/out", names, "csv", SCHEMA, ",".join(COLUMNS))


@query(f"WITH {STG} SELECT {LINE} AS line, count(*) AS n FROM stg GROUP BY 1")
def skip_numbered(t: Tables) -> DataFrame:
    """The lines of numbered files that a second stream sees again: each file is kept once."""
    folder = session.work_folder(t.spark, "identical")
    delivered(t, f"{folder}/in", "orders_1.csv")
    for check in ("c", "d"):
        arrived = landing.landing_files(t.spark, f"{folder}/in", "orders_")
        landing.skip_identical(arrived, f"{folder}/t", f"{folder}/s", f"{folder}/{check}").awaitTermination()
    kept = t.spark.read.parquet(f"{folder}/t")
    lines = kept.select(F.explode(text.lines(F.col("content").cast("string"))).alias("line"))
    return lines.where(F.col("line") != HEADER).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, url FROM pages WHERE starts_with(url, 'https://www.')")
def match_prefix(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url").where(text.match_prefix(F.col("url"), "https://www."))


@query(EXPORT_SQL)
def delivered_version(t: Tables) -> DataFrame:
    """A delivery of many files as one version; the one before held other rows."""
    folder = session.work_folder(t.spark, "version") + "/out"
    whole = extract(t)
    for df in (whole.where(F.col("o_orderdate") < "1995-06-01"), whole):
        file_sinks.deliver_version(df, folder, "csv", KEYS, ROWS_PER_FILE)
    return versions.read_current(t.spark, folder, whole.schema, "csv", header=True, escape='"')
