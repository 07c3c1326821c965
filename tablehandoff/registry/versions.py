"""Version history of the events of each user, and of the orders of each customer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.functions import dates, state
from tablehandoff.operators import history
from tablehandoff.registry.base import Tables, query
from tablehandoff.sinks import tables

BY_USER, NEWEST = ["user_id"], ["ts", "event_id"]


def shown(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


def sql_shown(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"


RANKED = """r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS v,
  count(*) OVER (PARTITION BY user_id) AS n FROM events)"""


@query(f"WITH {RANKED} SELECT user_id, event_id, event_type, v AS version FROM r WHERE v < 10")
def capped_history(t: Tables) -> DataFrame:
    kept = history.capped_history(t.events, BY_USER, NEWEST)
    return kept.select("user_id", "event_id", "event_type", "version")


@query(f"""WITH {RANKED}, c AS (SELECT DISTINCT c_custkey AS user_id FROM customer),
p AS (SELECT user_id, n, event_id, CASE WHEN event_type <> 'error' THEN event_type ELSE '' END AS stored
  FROM r WHERE v = 3),
k AS (SELECT DISTINCT user_id, n FROM r)
SELECT c.user_id, coalesce(k.n, 0) AS versions,
  CASE WHEN k.n IS NULL THEN 'no history' WHEN p.user_id IS NULL THEN 'out of range'
    WHEN stored = '' THEN 'no id' ELSE 'found' END AS status, event_id, stored
FROM c LEFT JOIN k ON k.user_id = c.user_id LEFT JOIN p ON p.user_id = c.user_id""")
def version_at(t: Tables) -> DataFrame:
    """The fourth newest event per user; errors have no stored id, and every customer
    counts as a known user."""
    stored = F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("")
    events = t.events.select("user_id", "ts", "event_id", stored.alias("stored"))
    wanted = t.customer.select(F.col("c_custkey").alias("user_id"))
    return history.version_at(events, BY_USER, NEWEST, 3, "stored", wanted).drop("ts")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC, o_orderkey DESC) - 1 AS v, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT k.o_custkey, n AS versions, CASE WHEN r.o_orderkey IS NULL THEN 'out of range' ELSE 'found' END AS status,
  r.o_orderkey
FROM (SELECT DISTINCT o_custkey, n FROM r) k LEFT JOIN (SELECT o_custkey, o_orderkey FROM r WHERE v = 20) r
  ON k.o_custkey = r.o_custkey""")
def version_out_of_range(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    found = history.version_at(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], 20)
    return found.drop("o_orderdate")


@query(f"WITH {RANKED} SELECT user_id, event_id, event_type, value FROM r WHERE v = 0")
def latest_per_key(t: Tables) -> DataFrame:
    last = history.latest_per_key(t.events, BY_USER, NEWEST)
    return last.select("user_id", "event_id", "event_type", "value")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts, event_id) AS v FROM events) WHERE v = 1""")
def dedupe_first(t: Tables) -> DataFrame:
    first = history.dedupe_first_seen(t.events, BY_USER, NEWEST)
    return first.select("user_id", "event_id", "event_type")


@query(f"""SELECT user_id, event_id, {sql_shown('valid_from')}, {sql_shown('valid_to')},
  valid_to IS NOT NULL AS archived
FROM (SELECT user_id, event_id, ts AS valid_from,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events)""")
def version_intervals(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "event_id", F.col("ts").alias("valid_from"))
    found = history.version_intervals(events, BY_USER, ["valid_from", "event_id"], "valid_from")
    return found.select("user_id", "event_id", shown("valid_from"), shown("valid_to"), "archived")


@query(f"WITH {RANKED} SELECT user_id, event_id, CASE WHEN v = 0 THEN 'LATEST' ELSE event_type END AS event_type FROM r")
def patch_latest(t: Tables) -> DataFrame:
    patched = history.patch_latest(t.events, BY_USER, NEWEST, "event_type", F.lit("LATEST"))
    return patched.select("user_id", "event_id", "event_type")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS v FROM events) WHERE v = 1""")
def upsert_latest(t: Tables) -> DataFrame:
    """State of the first half of the month, updated by the second half."""
    events = t.events.select("user_id", "event_type", "ts", "event_id", "value")
    half = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    merged = tables.upsert_latest(
        events.where(F.col("ts") < half),
        events.where(F.col("ts") >= half),
        ["user_id", "event_type"],
        NEWEST,
    )
    return merged.drop("ts")


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events")
def utc_stamp(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.utc_stamp(F.col("ts")).alias("stamp"))


@query("""SELECT event_id, (props->>'$.k')::INT AS k, 'pending' AS status, '' AS extra FROM events""")
def json_state(t: Tables) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("k INT, status STRING")
    read = state.read_state(F.col("props"), schema, {"k": F.lit(0), "status": F.lit("pending")})
    extra = F.array_join(F.map_keys("s.extras"), ",").alias("extra")
    return t.events.select("event_id", read.alias("s")).select("event_id", "s.k", "s.status", extra)


@query("""SELECT event_id, 0 AS k, 'k' AS extra, props->>'$.k' AS value FROM events""")
def json_extras(t: Tables) -> DataFrame:
    """Fields the schema does not name are kept."""
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("version INT")
    read = state.read_state(F.col("props"), schema, {"version": F.lit(0)})
    pairs = t.events.select("event_id", read.alias("s"))
    return pairs.select("event_id", F.col("s.version").alias("k"), F.explode("s.extras").alias("extra", "value"))


@query("""SELECT event_id, (i - 1)::INT AS seq, l[i] AS ref FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN [] ELSE ['sql/' || event_type, 'sql/' || user_id] END
    || ['tests/' || event_id] AS l FROM events), range(1, 4) r(i) WHERE i <= len(l)""")
def flatten_refs(t: Tables) -> DataFrame:
    """A list of load files (missing for errors) and a list of expected files."""
    load = F.when(
        F.col("event_type") != "error",
        F.array(F.concat(F.lit("sql/"), "event_type"),
                F.concat(F.lit("sql/"), F.col("user_id").cast("string"))),
    )
    expected = F.array(F.concat(F.lit("tests/"), F.col("event_id").cast("string")))
    refs = state.flatten_refs(load, expected)
    return t.events.select("event_id", F.posexplode(refs).alias("seq", "ref"))


@query("""SELECT event_id, (props->>'$.k')::INT AS k, 'pending' AS status, event_type AS note FROM events""")
def state_round_trip(t: Tables) -> DataFrame:
    """A state struct written as text and read again, with a null field kept."""
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("k INT, status STRING, note STRING, gone STRING")
    first = state.read_state(F.col("props"), schema, {
        "k": F.lit(0), "status": F.lit("pending"), "note": F.col("event_type"),
        "gone": F.lit(None).cast("string"),
    })
    written = t.events.select("event_id", state.write_state(first).alias("json"))
    again = written.select("event_id", state.read_state(F.col("json"), schema).alias("s"))
    return again.select("event_id", "s.k", "s.status", "s.note")
