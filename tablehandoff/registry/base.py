"""Registration of queries next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehandoff import session
from tablehandoff.functions.text import WHITESPACE

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(fn):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


class Tables:
    """The given tables by name: ``t.orders``; each is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self.__dict__[name] = table
        return table


# SQL pieces shared by several oracles.



def sql_strip(expr: str) -> str:
    codes = " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE)
    return f"trim({expr}, {codes})"


STG = """stg AS (
  SELECT c_custkey, c_name, c_mktsegment, o_orderkey,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice, o_orderpriority
  FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'O')"""

BIG_PRICE = 400_000


def staged(t: Tables) -> DataFrame:
    """Customers with their open orders, the order date still a date."""
    from tablehandoff.plans.jobs import staging_join

    return staging_join(
        t.customer,
        t.orders,
        ("c_custkey", "o_custkey"),
        F.col("o_orderstatus") == "O",
        ["c_custkey", "c_name", "c_mktsegment", "o_orderkey", "o_orderdate", "o_totalprice",
         "o_orderpriority"],
    )


def big_orders(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_totalprice") > BIG_PRICE)


# A job is a source, a language and a size class.
SQL_JOB = "source || '/' || lang || '/' || (n_chars // 500)"

# Two snapshots of the documents. Before: the labelled ones, those of low quality with their
# lines joined and the language unknown. Now: all but those labelled toxic, as they are.
SNAPSHOTS = f"""cur AS (
  SELECT d.doc_id, source, lang, {SQL_JOB} AS job, sha256(text) AS h
  FROM documents d WHERE NOT EXISTS (
    SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)),
prev AS (
  SELECT d.doc_id, source, CASE WHEN quality = 1 THEN lang END AS lang, {SQL_JOB} AS job,
         sha256(CASE WHEN quality = 1 THEN text ELSE replace(text, chr(10), ' ') END) AS h
  FROM documents d JOIN labels USING (doc_id))"""

# Same, as paths: the directory follows from the language.
SQL_DIR = "CASE d.lang WHEN 'en' THEN 'sql' WHEN 'de' THEN 'mappings' " \
    "WHEN 'es' THEN 'tests' ELSE 'misc' END"
DIRECTORY = {"en": "sql", "de": "mappings", "es": "tests", "fr": "misc"}


def document_path() -> Column:
    pairs = [F.lit(x) for pair in DIRECTORY.items() for x in pair]
    top = F.element_at(F.create_map(*pairs), F.col("lang"))
    return F.concat(top, F.lit("/"), F.col("doc_id").cast("string"))


def job_name() -> Column:
    size = F.floor(F.col("n_chars") / 500).cast("string")
    return F.concat("source", F.lit("/"), "lang", F.lit("/"), size)


def hashed_documents(t: Tables, **contents: Column) -> DataFrame:
    """Texts are hashed in the scan, so that only digests travel through the joins."""
    return t.documents.select(
        "doc_id",
        "source",
        "lang",
        job_name().alias("job"),
        document_path().alias("path"),
        *[F.sha2(c, 256).alias(name) for name, c in contents.items()],
    )


def current_documents(t: Tables) -> DataFrame:
    toxic = t.labels.where(F.col("toxic") == 1)
    return hashed_documents(t, hash=F.col("text")).join(toxic, "doc_id", "left_anti")


def previous_documents(t: Tables) -> DataFrame:
    joined = F.replace("text", F.lit("\n"), F.lit(" "))
    good = F.col("quality") == 1
    return (
        hashed_documents(t, whole=F.col("text"), joined=joined)
        .join(t.labels, "doc_id")
        .withColumn("lang", F.when(good, F.col("lang")))
        .withColumn("hash", F.when(good, F.col("whole")).otherwise(F.col("joined")))
        .select("doc_id", "job", "path", "source", "lang", "quality", "hash")
    )


def document_refs(t: Tables) -> DataFrame:
    """Labelled documents as references: good ones are samples, toxic ones also specs."""
    labelled = (
        t.documents.select("doc_id", job_name().alias("job"), document_path().alias("path"))
        .join(t.labels, "doc_id")
    )
    categories = F.array_compact(
        F.array(
            F.when(F.col("quality") == 1, F.lit("samples")),
            F.when(F.col("toxic") == 1, F.lit("specs")),
        )
    )
    return labelled.select("job", "path", F.explode(categories).alias("category"))
