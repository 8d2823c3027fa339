"""Events as an amendment ledger: merging, conflicts, lanes, overlays."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigora.functions.text import replace_first
from vigora.operators import ledger, quality
from vigora.plans.catalog import query
from vigora.sources.readers import table

STATUS = "CASE event_id % 5 WHEN 0 THEN 'materialized' WHEN 1 THEN 'validated' WHEN 2 THEN 'candidate' WHEN 3 THEN 'needs_review' ELSE 'rejected' END"


def status(shift: int = 0):
    k = (F.col("event_id") + shift) % 5
    return F.when(k == 0, "materialized").when(k == 1, "validated").when(k == 2, "candidate").when(k == 3, "needs_review").otherwise("rejected")


RANK = "CASE status WHEN 'materialized' THEN 3 WHEN 'validated' THEN 2 WHEN 'candidate' THEN 1 WHEN 'needs_review' THEN 0 ELSE -1 END"


@query("ledger_merge", f"""WITH u AS (SELECT event_id, {STATUS} AS status, 0 AS src_ord FROM events WHERE event_id % 3 <> 0
 UNION ALL SELECT event_id, {STATUS.replace('event_id % 5', '(event_id + 2) % 5')} AS status, 1 AS src_ord FROM events WHERE event_id % 3 <> 1)
 SELECT event_id, status, src_ord FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {RANK} DESC, src_ord) AS n FROM u) WHERE n = 1""")
def ledger_merge(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id")
    first = events.where("event_id % 3 <> 0").withColumn("status", status())
    second = events.where("event_id % 3 <> 1").withColumn("status", status(2))
    return ledger.merge([first, second], "event_id", ledger.status_rank(F.col("status"))).select("event_id", "status", "src_ord")


@query("same_slot_conflicts", """WITH e AS (SELECT *, CAST(ts AS DATE) AS day, event_id % 2 = 0 AS clean, event_id % 3 = 0 AS mat FROM events),
 s AS (SELECT user_id, day FROM e GROUP BY user_id, day HAVING count(*) >= 2 AND NOT (sum(clean::INT) = 1 AND sum((NOT clean AND mat)::INT) = 0) AND (count(DISTINCT sha256(props)) > 1 OR count(DISTINCT event_type) > 1))
 SELECT e.event_id, e.user_id, s.user_id IS NOT NULL AS conflict FROM e LEFT JOIN s ON e.user_id = s.user_id AND e.day = s.day""")
def same_slot_conflicts(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return ledger.conflicts(events, "user_id", "day", "props", "event_type", F.col("event_id") % 2 == 0, F.col("event_id") % 3 == 0).select("event_id", "user_id", "conflict")


LANES = [("metadata_only", "value < 5"), ("forms_pending", "event_type = 'signup'"), ("rescinded", "event_id % 50 = 0"), ("undated", "ts IS NULL"), ("before_base", "ts < TIMESTAMP '2024-01-03 00:00:00'"), ("conflict", "user_id % 17 = 0")]
LANE_SQL = "CASE " + " ".join(f"WHEN {sql} THEN '{name}'" for name, sql in LANES) + " ELSE 'ready' END"


def routed(spark, sf_dir):
    return ledger.route(table(spark, sf_dir, "events"), [(n, F.expr(sql)) for n, sql in LANES])


@query("lane_routing", f"SELECT event_id, {LANE_SQL} AS lane FROM events")
def lane_routing(spark, sf_dir):
    return routed(spark, sf_dir).select("event_id", "lane")


@query("gap_breakdown", f"""WITH g AS (SELECT {LANE_SQL} || ':' || event_type AS reason, list_filter([CASE WHEN value > 20 THEN 'large' END, CASE WHEN user_id < 10 THEN 'core' END], lambda x: x IS NOT NULL) AS rs FROM events)
 SELECT 'skip_reason' AS kind, split_part(reason, ':', 1) AS value, count(*) AS n FROM g GROUP BY 2 UNION ALL SELECT 'review_reason', r, count(*) FROM (SELECT unnest(rs) AS r FROM g) GROUP BY 2""")
def gap_breakdown(spark, sf_dir):
    rows = routed(spark, sf_dir).select(F.concat_ws(":", "lane", "event_type").alias("reason"), ledger.reasons([("large", F.col("value") > 20), ("core", F.col("user_id") < 10)]).alias("rs"))
    return ledger.breakdown(rows, "reason", "rs")


@query("json_payload_extract", "SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k FROM events")
def json_payload_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(-1)).cast("bigint").alias("k"))


@query("apply_decisions", "SELECT e.event_id, CASE WHEN e.event_id % 7 = 0 THEN 'validated' ELSE e.event_type END AS event_type, e.event_id % 7 = 0 AS decided FROM events e")
def apply_decisions(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    decisions = events.where("event_id % 7 = 0").select("event_id", F.lit("validated").alias("event_type"))
    return ledger.apply_decisions(events.select("event_id", "event_type"), decisions, "event_id", ["event_type"])


@query("apply_corrigenda", """WITH s AS (SELECT doc_id, source, text, CASE WHEN strpos(text, ' the ') > 0 THEN substr(text, 1, strpos(text, ' the ') - 1) || ' THE ' || substr(text, strpos(text, ' the ') + 5) ELSE text END AS once FROM documents),
 t AS (SELECT *, CASE WHEN strpos(once, ' of ') > 0 THEN substr(once, 1, strpos(once, ' of ') - 1) || ' from ' || substr(once, strpos(once, ' of ') + 4) ELSE once END AS twice FROM s)
 SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN text <> twice ELSE false END AS corrected, sha256(CASE WHEN source IN ('src1', 'src2') THEN twice ELSE text END) AS after_sha256 FROM t""")
def apply_corrigenda(spark, sf_dir):
    rows = [(s, k, a, b) for s in ("src1", "src2") for k, (a, b) in enumerate([(" the ", " THE "), (" of ", " from ")])]
    corrigenda = spark.createDataFrame(rows, "source string, seq int, old string, new string")
    return ledger.apply_corrigenda(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), corrigenda, "source", "text").select("doc_id", "corrected", "after_sha256")


@query("rescinded_flags", "SELECT e.event_id, r.user_id IS NOT NULL AS rescinded FROM events e LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value > 40) r ON e.user_id = r.user_id")
def rescinded_flags(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return ledger.rescinded(events, "user_id", events.where("event_type = 'error' AND value > 40").select("user_id")).select("event_id", "rescinded")


SPANS = "SELECT event_id, user_id, event_type, CAST(event_id % 100 AS INTEGER) AS s, CAST(event_id % 100 + 10 + event_id % 7 AS INTEGER) AS e FROM events"


@query("covering_events", f"""WITH x AS ({SPANS}) SELECT a.event_id, min(b.event_id) AS covering_event FROM x a LEFT JOIN x b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.event_id <> b.event_id AND b.event_id % 4 = 0
 AND greatest(0, least(a.e, b.e) - greatest(a.s, b.s)) >= 0.8 * least(a.e - a.s, b.e - b.s) GROUP BY a.event_id""")
def covering_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.col("event_id") % 100).cast("int").alias("s"), (F.col("event_id") % 100 + 10 + F.col("event_id") % 7).cast("int").alias("e"))
    return ledger.covering(rows, rows.where("event_id % 4 = 0"), ["user_id", "event_type"], "s", "e", "event_id").select("event_id", "covering_event")


@query("linkage_index", """SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_orderkey)), ',') AS orders, array_to_string(list_sort(list(DISTINCT CASE WHEN l_partkey % 3 = 0 THEN l_partkey END) FILTER (l_partkey % 3 = 0)), ',') AS rules FROM lineitem GROUP BY l_suppkey""")
def linkage_index(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    made = ledger.linkage(rows, "l_suppkey", "l_orderkey", "l_partkey", F.when(F.col("l_partkey") % 3 == 0, "rule").otherwise("form"))
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return made.select("l_suppkey", join("events").alias("orders"), join("rules").alias("rules"))


@query("commencement_dates", "SELECT user_id, event_type, arg_max(ts, event_id) AS ts FROM events e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = e.event_type AND x.value > 48) GROUP BY user_id, event_type")
def commencement_dates(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return ledger.commencement(events, ["user_id", "event_type"], "ts", "event_id", events.where("value > 48").select("user_id", "event_type").distinct())


@query("section_ranges", "SELECT n_nationkey, unnest(range(n_nationkey, n_nationkey + n_regionkey + 1))::INTEGER AS section FROM nation")
def section_ranges(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").withColumn("high", F.col("n_nationkey") + F.col("n_regionkey"))
    return ledger.expand_ranges(rows, "n_nationkey", "high", "section").select("n_nationkey", "section")


@query("superseded_by", """WITH r AS (SELECT event_id, ts, CASE WHEN event_type = 'error' THEN event_id - 10 END AS refers FROM events)
 SELECT superseded, superseding FROM (SELECT o.event_id AS superseded, l.event_id AS superseding, row_number() OVER (PARTITION BY o.event_id ORDER BY l.ts, l.event_id) AS n FROM r l JOIN r o ON l.refers = o.event_id AND l.ts >= o.ts) WHERE n = 1""")
def superseded_by(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("refers", F.when(F.col("event_type") == "error", F.col("event_id") - 10))
    return ledger.superseded(rows, "event_id", "refers", "ts")


@query("repeated_review_items", "SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1 AS repeat FROM events")
def repeated_review_items(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("key", F.concat_ws("|", "user_id", "event_type"))
    return ledger.first_seen(rows, "key", "event_id").select("event_id", "repeat")


@query("review_report", "SELECT event_type, status, n FROM (SELECT event_type, " + STATUS + " AS status, count(*) AS n FROM events GROUP BY ROLLUP (1, 2))")
def review_report(spark, sf_dir):
    return quality.totals(table(spark, sf_dir, "events").select("event_type", status().alias("status")), "event_type", "status")


@query("triage_classes", """SELECT event_id, CASE WHEN event_type IN ('error') THEN 'special_operation' WHEN user_id % 9 = 0 THEN 'forms_lane' WHEN event_type = 'signup' THEN 'commencement' WHEN value < 5 THEN 'metadata_only'
 WHEN user_id >= 100 THEN 'outside_work' WHEN event_type <> 'view' THEN 'needs_parser' WHEN value > 20 THEN 'unknown_operation' ELSE 'non_operative_text' END AS triage FROM events""")
def triage_classes(spark, sf_dir):
    kind = F.col("event_type")
    op = F.when(kind == "error", "CORRIGENDUM").when(kind == "signup", "COMMENCE").when(kind == "view", "UNKNOWN").otherwise("SUBSTITUTE")
    lane = F.when(F.col("user_id") % 9 == 0, "forms").when(F.col("value") < 5, "metadata_only").otherwise("ready")
    return table(spark, sf_dir, "events").select("event_id", quality.triage(op, lane, F.col("user_id") < 100, F.col("value") > 20).triage.alias("triage"))


@query("gap_queue", """WITH g AS (SELECT event_id, user_id, CASE event_id % 4 WHEN 0 THEN 'apply_failed:x' WHEN 1 THEN 'target_not_in_store:x' WHEN 2 THEN 'same_effective_date_conflict' ELSE 'partial_apply:y' END AS reason FROM events),
 l AS (SELECT *, CASE WHEN reason LIKE 'apply_failed%' OR reason LIKE 'partial_apply%' THEN 'text_repair' WHEN reason LIKE 'same%' THEN 'sequencing' ELSE 'anchor' END AS lane FROM g),
 p AS (SELECT *, -(CASE WHEN user_id IN (3, 5) THEN 100 ELSE 0 END) - (CASE WHEN lane = 'anchor' THEN 20 ELSE 0 END) - (CASE WHEN lane = 'sequencing' THEN 15 ELSE 0 END) - (CASE WHEN reason LIKE 'partial%' THEN 10 ELSE 0 END) AS priority FROM l)
 SELECT event_id, lane, priority FROM p""")
def gap_queue(spark, sf_dir):
    k = F.col("event_id") % 4
    reason = F.when(k == 0, "apply_failed:x").when(k == 1, "target_not_in_store:x").when(k == 2, "same_effective_date_conflict").otherwise("partial_apply:y")
    rows = table(spark, sf_dir, "events").withColumn("reason", reason).withColumn("lane", quality.gap_lane(F.col("reason")))
    return rows.withColumn("priority", quality.gap_priority(F.col("lane"), F.col("reason"), F.col("user_id").isin(3, 5))).select("event_id", "lane", "priority")


@query("first_occurrence_replace", "SELECT conv_id, turn, CASE WHEN strpos(text, 'the') > 0 THEN substr(text, 1, strpos(text, 'the') - 1) || '[X]' || substr(text, strpos(text, 'the') + 3) ELSE text END AS text FROM conversations")
def first_occurrence_replace(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", replace_first(F.col("text"), F.lit("the"), F.lit("[X]")).alias("text"))
