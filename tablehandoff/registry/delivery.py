"""Staging, export, delivery and its checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.functions import dates
from tablehandoff.operators import assertions, render, rows
from tablehandoff.plans.jobs import DownloadJob, run_download
from tablehandoff.registry.base import STG, Tables, query, staged
from tablehandoff.session import work_folder
from tablehandoff.sinks import files as file_sinks
from tablehandoff.sinks import tables
from tablehandoff.sources.files import FixedColumn

RUN_DATE = date(2026, 2, 10)
COLUMNS = ["c_custkey", "c_name", "o_orderkey", "o_orderdate", "o_totalprice"]
ROWS_PER_FILE = 2_000_000
DATES = {"o_orderdate": "YYYY-MM-DD"}
LAYOUT = [
    FixedColumn("c_custkey", 14, "bigint", "right", " "),
    FixedColumn("c_name", 30),
    FixedColumn("o_orderkey", 14, "bigint", "right", " "),
    FixedColumn("o_orderdate", 10),
    FixedColumn("o_totalprice", 16, "double", "right", " "),
]
EXPORT_SQL = f"WITH {STG} SELECT {', '.join(COLUMNS)} FROM stg"


@query(f"WITH {STG} SELECT * FROM stg")
def staging_load(t: Tables) -> DataFrame:
    """Filtered join written as the job's staging table (full refresh)."""
    table = tables.refresh_staging(staged(t), "customer_orders", work_folder(t.spark, "staging"))
    return table.withColumn("o_orderdate", dates.format_date(F.col("o_orderdate")))


@query(EXPORT_SQL)
def export_rows(t: Tables) -> DataFrame:
    return rows.export(staged(t), COLUMNS, ["c_custkey", "o_orderkey"], DATES)


@query(f"""WITH {STG} SELECT o_orderkey,
  ((row_number() OVER (ORDER BY o_orderkey) - 1) // 500 + 1)::BIGINT AS page FROM stg""")
def paginate(t: Tables) -> DataFrame:
    return rows.paginate(staged(t).select("o_orderkey"), ["o_orderkey"], 500)


@query(f"WITH {STG} SELECT o_orderkey, c_custkey FROM stg ORDER BY o_orderkey LIMIT 200 OFFSET 200")
def page_of_export(t: Tables) -> DataFrame:
    return rows.page(staged(t).select("o_orderkey", "c_custkey"), ["o_orderkey"], 2, 200)


def download(t: Tables, fmt: str, ext: str) -> DataFrame:
    """The whole job; the rows come back from the delivered files."""
    folder = work_folder(t.spark, "job")
    job = DownloadJob(
        name="customer_orders",
        load=staged(t),
        columns=COLUMNS,
        order_by=["c_custkey", "o_orderkey"],
        directory=f"{folder}/out",
        pattern="customer_orders_{yyyymmdd}." + ext,
        run_date=RUN_DATE,
        staging_folder=f"{folder}/staging",
        fmt=fmt,
        dates_as=DATES,
        layout=LAYOUT,
        header=",".join(COLUMNS) if fmt == "csv" else None,
        not_null=["c_custkey", "o_orderkey"],
        rows_per_file=ROWS_PER_FILE,
    )
    return run_download(job).delivered


@query(EXPORT_SQL)
def download_job(t: Tables) -> DataFrame:
    return download(t, "csv", "csv")


@query(EXPORT_SQL)
def download_fixed(t: Tables) -> DataFrame:
    return download(t, "fixed", "dat")


@query(EXPORT_SQL)
def download_json(t: Tables) -> DataFrame:
    return download(t, "json", "json")


@query(EXPORT_SQL)
def download_xml(t: Tables) -> DataFrame:
    return download(t, "xml", "xml")


@query("SELECT c_custkey AS CustomerId, c_name AS Name FROM customer")
def field_map(t: Tables) -> DataFrame:
    mapping = t.spark.createDataFrame(
        [("c_custkey", "CustomerId"), ("c_name", "Name")], "source string, target string"
    )
    return rows.apply_field_map(t.customer, mapping)


@query(f"""WITH {STG}, c AS (SELECT *, o_totalprice::DECIMAL(14,2)::VARCHAR AS price FROM stg)
SELECT o_orderkey,
  lpad(c_custkey::VARCHAR, 14, ' ') || rpad(c_name, 30, ' ') || lpad(o_orderkey::VARCHAR, 14, ' ')
    || rpad(o_orderdate, 10, ' ') || lpad(price, 16, ' ') AS line,
  length(c_custkey::VARCHAR) <= 14 AND length(c_name) <= 30 AND length(o_orderkey::VARCHAR) <= 14
    AND length(price) <= 16 AS fits
FROM c""")
def fixed_width_lines(t: Tables) -> DataFrame:
    extract = (
        staged(t).select(*rows.export_columns(COLUMNS, DATES))
        .withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(14,2)"))
    )
    return extract.select(
        "o_orderkey",
        file_sinks.fixed_line(LAYOUT).alias("line"),
        (~file_sinks.any_misfit(LAYOUT)).alias("fits"),
    )


@query(f"WITH {STG} SELECT c_custkey, c_name, o_orderkey, o_orderdate FROM stg")
def json_lines(t: Tables) -> DataFrame:
    extract = staged(t).select(*rows.export_columns(COLUMNS, DATES))
    line = extract.select(F.to_json(F.struct(*COLUMNS), {"ignoreNullFields": "false"}).alias("line"))
    fields = F.from_json("line", "c_custkey BIGINT, c_name STRING, o_orderkey BIGINT, o_orderdate STRING")
    return line.select(fields.alias("f")).select("f.*")


@query(f"""WITH {STG} SELECT (SELECT count(*) FROM stg) AS delivered,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS staged,
  (SELECT count(*) FROM stg) = (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS passed""")
def assert_row_count(t: Tables) -> DataFrame:
    return assertions.row_count_matches(staged(t), t.orders.where(F.col("o_orderstatus") == "O"))


def with_gaps(t: Tables) -> DataFrame:
    """Open orders where low priorities are unset."""
    return staged(t).withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))


@query(f"""WITH {STG} SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS nulls FROM stg
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority = '5-LOW') FROM stg""")
def assert_no_nulls(t: Tables) -> DataFrame:
    return assertions.null_counts(with_gaps(t), ["o_orderkey", "o_orderpriority"])


@query(f"""WITH {STG} SELECT c_custkey, count(*) AS "rows" FROM stg GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(t: Tables) -> DataFrame:
    return assertions.duplicate_keys(staged(t), ["c_custkey"])


GOLDEN_SQL = f"""{STG}, actual AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) AS position, o_orderkey, o_orderpriority, c_name FROM stg),
golden AS (SELECT position, o_orderpriority = '2-HIGH' AS changed FROM actual WHERE position <= 5)"""


def golden_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    actual = staged(t).select("o_orderkey", "o_orderpriority", "c_name")
    changed = F.when(F.col("o_orderpriority") == "2-HIGH", "HIGH").otherwise(F.col("o_orderpriority"))
    return actual, actual.withColumn("o_orderpriority", changed)


@query(f"""WITH {GOLDEN_SQL} SELECT position, NOT changed AS matches,
  CASE WHEN changed THEN 'o_orderpriority' ELSE '' END AS differing FROM golden""")
def golden_compare(t: Tables) -> DataFrame:
    actual, expected = golden_sides(t)
    return assertions.golden_compare(
        actual, expected, ["o_orderkey", "o_orderpriority", "c_name"], ["o_orderkey"]
    )


@query(f"""WITH {GOLDEN_SQL}, n AS (SELECT count(*) AS s,
  count(*) FILTER (o_orderpriority = '5-LOW') AS low FROM stg),
dup AS (SELECT count(*) AS d FROM (SELECT 1 FROM stg GROUP BY c_custkey HAVING count(*) > 1)),
o AS (SELECT count(*) AS o FROM orders WHERE o_orderstatus = 'O'),
g AS (SELECT count(*) FILTER (changed) AS g FROM golden)
SELECT 'row count' AS assertion, s = o AS passed,
  'delivered ' || s || ' rows, staged ' || o AS detail FROM n, o
UNION ALL SELECT 'no null values in o_orderkey', true, '0 null values' FROM n
UNION ALL SELECT 'no null values in o_orderpriority', low = 0, low || ' null values' FROM n
UNION ALL SELECT 'unique key c_custkey', d = 0, d || ' keys occur more than once' FROM dup
UNION ALL SELECT 'golden rows', g = 0, g || ' rows differ' FROM g""")
def assertion_results(t: Tables) -> DataFrame:
    actual, expected = golden_sides(t)
    return assertions.run_assertions([
        assertions.assert_row_count(staged(t), t.orders.where(F.col("o_orderstatus") == "O")),
        assertions.assert_no_nulls(with_gaps(t), ["o_orderkey", "o_orderpriority"]),
        assertions.assert_unique(staged(t), ["c_custkey"]),
        assertions.assert_golden(
            actual, expected, ["o_orderkey", "o_orderpriority", "c_name"], ["o_orderkey"]
        ),
    ])


@query("""SELECT c_nationkey, 0::BIGINT AS part,
  sha256(string_agg(c_custkey || '|' || c_name || chr(10), '' ORDER BY c_custkey)) AS digest
FROM customer GROUP BY 1""")
def render_files(t: Tables) -> DataFrame:
    """One file per nation, rendered by a function over its sorted rows."""

    def pipes(records: list[dict]) -> bytes:
        return "".join(f"{r['c_custkey']}|{r['c_name']}\n" for r in records).encode()

    files = render.render_with(
        t.customer.select("c_nationkey", "c_custkey", "c_name"), pipes, "c_nationkey", ["c_custkey"],
        rows_per_part=100_000,
    )
    return files.select("c_nationkey", "part", F.sha2("content", 256).alias("digest"))
