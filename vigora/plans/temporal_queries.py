"""Histories of users' events: each event opens a version that the user's next event closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigora.functions.text import text_hash
from vigora.operators import temporal
from vigora.plans.catalog import query
from vigora.sources.readers import table

VERSIONS = """SELECT *, row_number() OVER w AS seq, ts AS valid_from, lead(ts) OVER w AS valid_to,
 count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS chain_length
 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
AT, LOW, HIGH = "2024-01-15 00:00:00", "2024-01-08 00:00:00", "2024-01-20 00:00:00"


def day(x: str):
    return F.to_timestamp_ntz(F.lit(x))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.intervals(table(spark, sf_dir, "events"), "user_id", "ts", "event_id")


@query("version_intervals", f"SELECT event_id, user_id, seq, valid_from, valid_to, chain_length, event_type FROM ({VERSIONS})")
def version_intervals(spark, sf_dir):
    return versions(spark, sf_dir).select("event_id", "user_id", "seq", "valid_from", "valid_to", "chain_length", "event_type")


COVER = "valid_from <= TIMESTAMP '{0}' AND (valid_to IS NULL OR TIMESTAMP '{0}' < valid_to)"
COLUMNS = "event_id, user_id, seq, valid_from, valid_to, event_type, value"


@query("as_of_lookup", f"SELECT {COLUMNS} FROM ({VERSIONS}) WHERE {COVER.format(AT)}")
def as_of_lookup(spark, sf_dir):
    return temporal.in_force(table(spark, sf_dir, "events"), "user_id", "ts", day(AT), "event_id").select(*COLUMNS.split(", "))


@query("as_of_or_last", f"""SELECT user_id, event_id, event_type, in_force FROM (SELECT *, {COVER.format('2024-01-01 06:00:00')} AS in_force,
 row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN {COVER.format('2024-01-01 06:00:00')} THEN 1 ELSE 0 END DESC, valid_from DESC, event_id DESC) AS n FROM ({VERSIONS})) WHERE n = 1""")
def as_of_or_last(spark, sf_dir):
    return temporal.as_of_or_last(versions(spark, sf_dir), "user_id", day("2024-01-01 06:00:00"), tie="event_id").select("user_id", "event_id", "event_type", "in_force")


@query("first_after", f"SELECT user_id, event_id, ts AS valid_from FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE ts > TIMESTAMP '{AT}') WHERE n = 1")
def first_after(spark, sf_dir):
    return temporal.first_after(versions(spark, sf_dir), "user_id", day(AT), tie="event_id").select("user_id", "event_id", "valid_from")


@query("last_before", f"SELECT user_id, event_id, ts AS valid_from FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE ts <= TIMESTAMP '{LOW}') WHERE n = 1")
def last_before(spark, sf_dir):
    return temporal.last_known(versions(spark, sf_dir), "user_id", day(LOW), tie="event_id").select("user_id", "event_id", "valid_from")


PROBES = "SELECT o_orderkey, o_custkey % 150 AS user_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(o_orderkey % 43200 AS INTEGER)) AS probe_ts FROM orders"


@query("as_of_join", f"""SELECT p.o_orderkey, p.user_id, p.probe_ts, e.ts AS version_start, e.event_id, e.event_type FROM ({PROBES}) p ASOF LEFT JOIN (SELECT * FROM events) e ON p.user_id = e.user_id AND p.probe_ts >= e.ts""")
def as_of_join(spark, sf_dir):
    probes = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 150).alias("user_id"), (day("2024-01-01 00:00:00") + F.make_dt_interval(mins=(F.col("o_orderkey") % 43200).cast("int"))).alias("probe_ts"))
    return temporal.as_of_join(probes, "user_id", "probe_ts", "o_orderkey", table(spark, sf_dir, "events"), "user_id", "ts", "event_id", "event_type")


@query("version_compare_two_dates", f"""WITH v AS ({VERSIONS}), s AS (SELECT user_id,
 max(CASE WHEN {COVER.format(LOW)} THEN event_type END) AS from_value, max(CASE WHEN {COVER.format(HIGH)} THEN event_type END) AS to_value,
 max(CASE WHEN {COVER.format(LOW)} THEN 1 ELSE 0 END) AS has_from, max(CASE WHEN {COVER.format(HIGH)} THEN 1 ELSE 0 END) AS has_to,
 sum(CASE WHEN valid_from > TIMESTAMP '{LOW}' AND valid_from <= TIMESTAMP '{HIGH}' THEN 1 ELSE 0 END)::BIGINT AS n_events FROM v GROUP BY user_id)
 SELECT user_id, from_value, to_value, coalesce(from_value, '') <> coalesce(to_value, '') AS changed, n_events,
 CASE WHEN has_from = 0 OR has_to = 0 THEN 'partial_history' ELSE 'ok' END AS status FROM s""")
def version_compare_two_dates(spark, sf_dir):
    return temporal.compare(versions(spark, sf_dir), "user_id", day(LOW), day(HIGH), "event_type")


@query("events_between", f"SELECT event_id, user_id, ts AS valid_from FROM events WHERE ts > TIMESTAMP '{LOW}' AND ts <= TIMESTAMP '{HIGH}'")
def events_between(spark, sf_dir):
    return temporal.between(versions(spark, sf_dir), day(HIGH), day(LOW)).select("event_id", "user_id", "valid_from")


@query("component_timeline", f"SELECT user_id, seq, event_id, valid_from, valid_to, event_type FROM ({VERSIONS}) WHERE user_id = 7")
def component_timeline(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("user_id = 7")
    return temporal.intervals(events, "user_id", "ts", "event_id").orderBy("seq").select("user_id", "seq", "event_id", "valid_from", "valid_to", "event_type")


@query("amendment_chain", "SELECT event_id, user_id, array_to_string(list(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), '>') AS chain FROM events")
def amendment_chain(spark, sf_dir):
    made = temporal.chains(table(spark, sf_dir, "events"), "user_id", "event_id", "ts", "event_id")
    return made.select("event_id", "user_id", F.array_join(F.transform("event_chain", lambda x: x.cast("string")), ">").alias("chain"))


INJECTED = f"SELECT user_id, event_id, valid_from, CASE WHEN event_id % 97 = 0 AND valid_to IS NOT NULL THEN valid_to + INTERVAL 1 DAY ELSE valid_to END AS valid_to FROM ({VERSIONS})"


@query("temporal_overlap_check", f"SELECT DISTINCT b.user_id, b.event_id, b.valid_from FROM ({INJECTED}) a JOIN ({INJECTED}) b ON a.user_id = b.user_id AND (a.valid_from, a.event_id) < (b.valid_from, b.event_id) AND (a.valid_to IS NULL OR b.valid_from < a.valid_to)")
def temporal_overlap_check(spark, sf_dir):
    rows = versions(spark, sf_dir).withColumn("valid_to", F.when((F.col("event_id") % 97 == 0) & F.col("valid_to").isNotNull(), F.col("valid_to") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("valid_to")))
    return temporal.overlaps(rows, "user_id", "event_id").select("user_id", "event_id", "valid_from")


@query("rate_change_points", """SELECT user_id, event_id, ts, event_type, previous FROM (SELECT *, lag(event_type) OVER w AS previous, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE n = 1 OR event_type IS DISTINCT FROM previous""")
def rate_change_points(spark, sf_dir):
    return temporal.change_points(table(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type"), "event_id").select("user_id", "event_id", "ts", "event_type", "previous")


@query("shrink_guard", """WITH t AS (SELECT doc_id, source, CASE WHEN doc_id % 5 = 0 THEN 'OMIT' ELSE 'SUBSTITUTE' END AS operation, text,
 max(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS longest FROM documents),
 g AS (SELECT *, coalesce(longest >= 500 AND length(text) < 0.3 * longest AND operation NOT IN ('OMIT', 'INSERT_SIBLING'), false) AS guarded FROM t)
 SELECT doc_id, source, guarded, CASE WHEN guarded THEN longest ELSE length(text) END::INTEGER AS n FROM g""")
def shrink_guard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("operation", F.when(F.col("doc_id") % 5 == 0, "OMIT").otherwise("SUBSTITUTE"))
    return temporal.shrink_guard(docs, "source", "text", "operation", "doc_id").select("doc_id", "source", "guarded", F.length("text").alias("n"))


@query("late_events", "SELECT event_id, ts, ts < max(ts) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS retrospective FROM events")
def late_events(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf_dir, "events").select("event_id", "ts", (F.col("ts") < F.max("ts").over(w)).alias("retrospective"))


@query("inherited_context", "SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS context FROM events")
def inherited_context(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("rule", F.when(F.col("event_type") == "signup", F.col("event_id")))
    return rows.select("event_id", temporal.inherited(rows, "user_id", "rule", "ts", "event_id").alias("context"))


@query("consecutive_runs", """WITH m AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS starts FROM events),
 i AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM m)
 SELECT user_id, island::BIGINT AS island, min(event_type) AS event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM i GROUP BY user_id, island""")
def consecutive_runs(spark, sf_dir):
    from pyspark.sql import Window

    events = table(spark, sf_dir, "events")
    starts = ~F.col("event_type").eqNullSafe(F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    rows = temporal.islands(events.withColumn("starts", starts), "user_id", F.col("starts"), "ts", "event_id")
    return rows.groupBy("user_id", "island").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("version_ids", "SELECT event_id, substr(sha256(concat_ws('|', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), sha256(props))), 1, 24) AS version_id FROM events")
def version_ids(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.substring(F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_id").cast("string"), text_hash("props")), 256), 1, 24).alias("version_id"))
