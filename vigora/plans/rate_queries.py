"""Parts and line items as rate schedules; reconciliation, tiers, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigora.functions import codes
from vigora.operators import quality, rates
from vigora.plans.catalog import query
from vigora.sources.readers import table
from vigora.streaming import streams

CELL = "lpad(CAST(p_partkey * 37 % 1000000 AS VARCHAR), 6, '0') || ' , ' || lpad(CAST(p_size AS VARCHAR), 2, '0') || ',x1 [other than 9999]'"
LIST = f"list_filter(list_transform(string_split(regexp_replace({CELL}, '\\[[^\\]]*\\]', '', 'g'), ','), lambda x: regexp_replace(x, '\\s+', '', 'g')), lambda x: regexp_full_match(x, '\\d{{2,8}}'))"


def cell():
    return F.concat(F.lpad((F.col("p_partkey") * 37 % 1000000).cast("string"), 6, "0"), F.lit(" , "), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit(",x1 [other than 9999]"))


def entries(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", F.explode(codes.code_list(cell())).alias("code"))


ENTRIES = f"SELECT p_partkey, p_brand, p_type, unnest({LIST}) AS code FROM part"


@query("code_explode", ENTRIES)
def code_explode(spark, sf_dir):
    return entries(spark, sf_dir)


@query("prefix_match", f"WITH e AS ({ENTRIES}), q AS (SELECT DISTINCT code AS q FROM e WHERE p_partkey % 50 = 0) SELECT q.q, e.p_partkey, e.code FROM q JOIN e ON q.q = e.code OR starts_with(q.q, e.code) OR starts_with(e.code, q.q)")
def prefix_match(spark, sf_dir):
    e = entries(spark, sf_dir).select("p_partkey", "code")
    q = entries(spark, sf_dir).where("p_partkey % 50 = 0").select(F.col("code").alias("q")).distinct()
    return rates.match_codes(q, "q", e, "code").select("q", "p_partkey", "code")


SNAP = "SELECT l_partkey % 500 AS code, l_shipdate AS date, l_orderkey * 10 + l_linenumber AS seq, l_tax AS rate, l_suppkey AS supp FROM lineitem"


def snapshots(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 500).alias("part"), F.col("l_shipdate").alias("date"), F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("a"), F.col("l_suppkey").alias("b"), F.col("l_tax").alias("c")).alias("seq"), F.col("l_tax").alias("rate"))


LEDGER = f"SELECT code, date, rate FROM (SELECT *, row_number() OVER (PARTITION BY code, date ORDER BY seq DESC, supp DESC, rate DESC) AS n FROM ({SNAP})) WHERE n = 1"


def ledger(spark, sf_dir):
    return rates.ledger(snapshots(spark, sf_dir), F.array("part"), "date").select("code", "date", "rate")


@query("rate_ledger", LEDGER)
def rate_ledger(spark, sf_dir):
    return ledger(spark, sf_dir)


@query("rate_ledger_latest", f"SELECT code, arg_max(date, date) AS date, arg_max(rate, date) AS rate FROM ({LEDGER}) GROUP BY code")
def rate_ledger_latest(spark, sf_dir):
    return rates.current(ledger(spark, sf_dir), "date")


@query("rate_at_date", f"SELECT code, arg_max(date, date) AS date, arg_max(rate, date) AS rate FROM ({LEDGER}) WHERE date <= TIMESTAMP '1998-06-01 00:00:00' GROUP BY code")
def rate_at_date(spark, sf_dir):
    return rates.at(ledger(spark, sf_dir), "date", F.to_timestamp_ntz(F.lit("1998-06-01 00:00:00")))


@query("rate_changes", f"SELECT code, date, rate, previous FROM (SELECT *, lag(rate) OVER (PARTITION BY code ORDER BY date) AS previous, row_number() OVER (PARTITION BY code ORDER BY date) AS n FROM ({LEDGER})) WHERE n = 1 OR rate IS DISTINCT FROM previous")
def rate_changes(spark, sf_dir):
    return rates.changes(ledger(spark, sf_dir), "code", "date", F.col("rate"))


@query("rate_breakdown", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' THEN round(l_tax, 4) END AS cess, CASE WHEN l_returnflag <> 'N' THEN round(l_tax, 4) END AS cgst, CASE WHEN l_returnflag <> 'N' THEN round(l_tax * 2, 4) END AS igst FROM lineitem")
def rate_breakdown(spark, sf_dir):
    made = table(spark, sf_dir, "lineitem").withColumn("b", codes.breakdown(F.col("l_tax"), F.col("l_returnflag") == "N"))
    return made.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.try_element_at("b", F.lit(k)).alias(k) for k in ("cess", "cgst", "igst")])


SCHED = """SELECT l_suppkey % 40 AS grp, l_orderkey * 100000000 + l_partkey * 1000 + l_suppkey % 1000 AS pos, min(l_quantity) AS l_quantity, min(l_partkey) AS l_partkey,
 min(l_linestatus) = 'O' AND min(l_quantity) > 45 AS omitted FROM lineitem GROUP BY 1, 2"""


def schedule(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 40).alias("grp"), (F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 1000 + F.col("l_suppkey") % 1000).alias("pos")).agg(
        F.min("l_quantity").alias("l_quantity"), F.min("l_partkey").alias("l_partkey"), F.min("l_returnflag").alias("l_returnflag"), ((F.min("l_linestatus") == "O") & (F.min("l_quantity") > 45)).alias("omitted"))
    return rows.withColumn("sno", F.col("l_quantity").cast("int").cast("string"))


@query("duplicate_serial", f"SELECT grp, pos FROM (SELECT *, row_number() OVER (PARTITION BY grp, CAST(l_quantity AS INTEGER) ORDER BY pos) AS n FROM ({SCHED}) WHERE NOT omitted) WHERE n > 1")
def duplicate_serial(spark, sf_dir):
    return rates.duplicate_serials(schedule(spark, sf_dir), ["grp"], codes.serial("sno"), "pos", F.col("omitted")).select("grp", "pos")


@query("serial_disorder", f"SELECT grp, pos, previous FROM (SELECT *, lag(CAST(l_quantity AS INTEGER)) OVER (PARTITION BY grp ORDER BY pos) AS previous FROM ({SCHED})) WHERE CAST(l_quantity AS INTEGER) < previous AND NOT omitted")
def serial_disorder(spark, sf_dir):
    return rates.serial_disorder(schedule(spark, sf_dir), ["grp"], codes.leading_int("sno"), "pos", F.col("omitted")).select("grp", "pos", "previous")


@query("serial_gaps", f"WITH s AS (SELECT DISTINCT grp, CAST(l_quantity AS INTEGER) AS n FROM ({SCHED})), m AS (SELECT grp, max(n) AS mx FROM s GROUP BY grp) SELECT m.grp, g.i::INTEGER AS missing FROM m, LATERAL (SELECT unnest(range(1, mx + 1)) AS i) g WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.grp = m.grp AND s.n = g.i)")
def serial_gaps(spark, sf_dir):
    return rates.serial_gaps(schedule(spark, sf_dir), ["grp"], codes.leading_int("sno"))


@query("implausible_serials", f"SELECT grp, pos FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM ({SCHED})) WHERE l_partkey > greatest(100, 3 * n)")
def implausible_serials(spark, sf_dir):
    return rates.implausible(schedule(spark, sf_dir), ["grp"], F.col("l_partkey")).select("grp", "pos")


@query("cross_group_overlap", f"SELECT code, count(DISTINCT p_brand) AS n_schedules, CASE WHEN length(code) = 2 AND max(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END) = 1 THEN 'benign' WHEN length(code) = 2 THEN 'hsn_overlap_chapter' ELSE 'hsn_overlap' END AS kind FROM ({ENTRIES}) GROUP BY code HAVING count(DISTINCT p_brand) >= 2")
def cross_group_overlap(spark, sf_dir):
    return rates.code_overlap(entries(spark, sf_dir), "code", "p_brand", F.when(F.col("p_type") == "PROMO", "excluding").otherwise("")).select("code", "n_schedules", "kind")


@query("chapter_subsumption", f"""WITH e AS ({ENTRIES}), s AS (SELECT code AS chapter, p_brand AS in_schedule FROM e WHERE length(code) = 2 GROUP BY 1, 2 HAVING max(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END) = 0)
 SELECT DISTINCT s.chapter, s.in_schedule, e.code, e.p_brand AS other FROM s JOIN e ON length(e.code) > 2 AND substr(e.code, 1, 2) = s.chapter WHERE e.p_brand <> s.in_schedule""")
def chapter_subsumption(spark, sf_dir):
    return rates.chapter_subsumption(entries(spark, sf_dir), "code", "p_brand", F.when(F.col("p_type") == "PROMO", "excluding").otherwise(""))


@query("rate_exempt_conflict", f"SELECT code FROM ({ENTRIES}) WHERE p_brand = 'Brand#1' INTERSECT SELECT code FROM ({ENTRIES}) WHERE p_brand = 'Brand#2'")
def rate_exempt_conflict(spark, sf_dir):
    e = entries(spark, sf_dir)
    return rates.exempt_conflict(e.where("p_brand = 'Brand#1'"), e.where("p_brand = 'Brand#2'"), "code")


@query("concordance", """WITH pre AS (SELECT * FROM part WHERE p_partkey % 2 = 0), post AS (SELECT * FROM part WHERE p_partkey % 2 = 1),
 h AS (SELECT pre.p_partkey AS pre_id, post.p_partkey AS post_id, 0 AS p, 'same' AS how, 0.9 AS c FROM pre JOIN post ON pre.p_brand = post.p_brand AND pre.p_type = post.p_type AND pre.p_size = post.p_size
 UNION ALL SELECT pre.p_partkey, post.p_partkey, 1, 'any', 0.7 FROM pre JOIN post ON pre.p_brand = post.p_brand AND pre.p_size = post.p_size UNION ALL SELECT pre.p_partkey, post.p_partkey, 2, 'name', 0.6 FROM pre JOIN post ON pre.p_name = post.p_name),
 b AS (SELECT *, row_number() OVER (PARTITION BY pre_id ORDER BY p, post_id) AS n FROM h)
 SELECT pre.p_partkey AS pre_id, b.post_id, coalesce(b.how, 'unmatched') AS how, coalesce(b.c, 0)::DOUBLE AS confidence FROM pre LEFT JOIN b ON b.pre_id = pre.p_partkey AND b.n = 1""")
def concordance(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    pre, post = part.where("p_partkey % 2 = 0").withColumn("pre_id", F.col("p_partkey")), part.where("p_partkey % 2 = 1").withColumn("post_id", F.col("p_partkey"))
    both = lambda *names: [(F.col(n), F.col(n)) for n in names]
    return rates.concordance(pre, post, [("same", 0.9, both("p_brand", "p_type", "p_size")), ("any", 0.7, both("p_brand", "p_size")), ("name", 0.6, both("p_name"))], "pre_id", "post_id", "p_partkey")


def reconcile_sides(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    base = o.select("o_orderkey", F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("text"), (F.col("o_totalprice") > 450000).alias("omitted"))
    cp = base.where("o_orderkey % 11 <> 0")
    mat = base.where("o_orderkey % 13 <> 0").withColumn("code", F.when(F.col("o_orderkey") % 17 == 0, "Z").otherwise(F.col("code"))).withColumn("text", F.when(F.col("o_orderkey") % 19 == 0, F.concat("text", F.lit("."))).when(F.col("o_orderkey") % 23 == 0, "quite other words").otherwise(F.col("text")))
    return cp, mat.withColumn("omitted", F.col("omitted") & (F.col("o_orderkey") % 3 != 0))


@query("reconcile_outer", """WITH b AS (SELECT o_orderkey AS k, o_orderstatus AS code, o_orderpriority AS text, o_totalprice > 450000 AS om FROM orders), cp AS (SELECT * FROM b WHERE k % 11 <> 0),
 m AS (SELECT k, CASE WHEN k % 17 = 0 THEN 'Z' ELSE code END AS code, CASE WHEN k % 19 = 0 THEN 1 WHEN k % 23 = 0 THEN 2 ELSE 0 END AS t, om AND k % 3 <> 0 AS om FROM b WHERE k % 13 <> 0)
 SELECT coalesce(cp.k, m.k) AS o_orderkey, CASE WHEN m.k IS NULL THEN CASE WHEN cp.om THEN 'cp_omitted_mat_missing' ELSE 'missing_in_materialised' END WHEN cp.k IS NULL THEN CASE WHEN m.om THEN 'mat_omitted_cp_missing' ELSE 'missing_in_checkpoint' END
 WHEN cp.om AND m.om THEN 'omitted_match' WHEN cp.om THEN 'cp_omitted_mat_active' WHEN m.om THEN 'mat_omitted_cp_active' WHEN cp.code <> m.code AND m.t < 2 THEN 'format_only' WHEN cp.code <> m.code THEN 'tariff_mismatch' WHEN m.t < 2 THEN 'exact' ELSE 'description_mismatch' END AS class FROM cp FULL JOIN m ON cp.k = m.k""")
def reconcile_outer(spark, sf_dir):
    cp, mat = reconcile_sides(spark, sf_dir)
    return rates.reconcile(cp, mat, ["o_orderkey"]).select("o_orderkey", "class")


@query("reconcile_rematch", """WITH l AS (SELECT p_type, substr(p_name, 1, 4) AS p, min(p_partkey) AS a, count(*) AS n FROM part WHERE p_partkey % 2 = 0 AND length(substr(p_name, 1, 4)) = 4 GROUP BY 1, 2), r AS (SELECT p_type, substr(p_name, 1, 4) AS p, min(p_partkey) AS b, count(*) AS n FROM part WHERE p_partkey % 2 = 1 AND length(substr(p_name, 1, 4)) = 4 GROUP BY 1, 2)
 SELECT a, b FROM l JOIN r USING (p_type, p) WHERE l.n = 1 AND r.n = 1""")
def reconcile_rematch(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return rates.rematch(part.where("p_partkey % 2 = 0").withColumn("a", F.col("p_partkey")), part.where("p_partkey % 2 = 1").withColumn("b", F.col("p_partkey")), "p_type", F.col("p_name"), "a", "b")


@query("schedule_validation")
def schedule_validation(spark, sf_dir):
    rows = schedule(spark, sf_dir).withColumn("code", F.lpad((F.col("l_partkey") % 10000).cast("string"), 4, "0"))
    return rates.validate(rows, "grp", codes.serial("sno"), "pos", "code", F.col("l_returnflag"), F.col("omitted"))


KIND = "CASE o_orderkey % 6 WHEN 0 THEN 'exact' WHEN 1 THEN 'format_only' WHEN 2 THEN 'minor' WHEN 3 THEN 'true_substantive_mismatch' WHEN 4 THEN 'missing_reconstruction' ELSE 'post_checkpoint' END"


def kind():
    k = F.col("o_orderkey") % 6
    return F.when(k == 0, "exact").when(k == 1, "format_only").when(k == 2, "minor").when(k == 3, "true_substantive_mismatch").when(k == 4, "missing_reconstruction").otherwise("post_checkpoint")


@query("confidence_score", f"SELECT o_orderkey, least(CASE {KIND} WHEN 'exact' THEN 1.0 WHEN 'format_only' THEN 0.95 ELSE CASE WHEN s >= 0.9 THEN 0.85 WHEN s >= 0.8 THEN 0.75 WHEN s >= 0.6 THEN 0.5 ELSE 0.25 END END, CASE WHEN o_orderstatus = 'P' THEN 0.8 ELSE 1.0 END)::DOUBLE AS confidence FROM (SELECT *, (o_custkey % 100) / 100.0 AS s FROM orders)")
def confidence_score(spark, sf_dir):
    made = codes.entry_confidence(kind(), (F.col("o_custkey") % 100) / 100.0, F.col("o_orderstatus") == "P")
    return table(spark, sf_dir, "orders").select("o_orderkey", made.cast("double").alias("confidence"))


TIER = f"""SELECT o_orderkey, CASE WHEN o_custkey % 20 = 0 OR o_custkey % 21 = 0 OR o_custkey % 22 = 0 THEN 'D' WHEN kind = 'missing_reconstruction' THEN 'D' WHEN kind = 'true_substantive_mismatch' THEN CASE WHEN review THEN 'D' ELSE 'C' END
 WHEN kind IN ('exact', 'format_only') THEN CASE WHEN review THEN 'B' ELSE 'A' END WHEN kind IN ('minor', 'post_checkpoint') THEN 'B' ELSE 'D' END AS tier, kind FROM (SELECT *, {KIND} AS kind, o_orderstatus = 'P' AS review FROM orders)"""


def tiers(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    made = quality.tier(F.col("o_custkey") % 20 == 0, F.col("o_custkey") % 21 == 0, F.col("o_custkey") % 22 == 0, kind(), F.col("o_orderstatus") == "P", F.lit(True))
    return o.select("o_orderkey", made.alias("tier"), kind().alias("kind"))


@query("confidence_tiers", f"SELECT a.o_orderkey, CASE WHEN a.tier = 'B' AND a.kind = 'post_checkpoint' AND p.tier = 'A' THEN 'A' ELSE a.tier END AS tier FROM ({TIER}) a LEFT JOIN ({TIER}) p ON p.o_orderkey = a.o_orderkey // 10")
def confidence_tiers(spark, sf_dir):
    rows = tiers(spark, sf_dir)
    return quality.promote(rows, "o_orderkey", F.floor(F.col("o_orderkey") / 10), F.lit("text"), F.col("kind") == "post_checkpoint").select("o_orderkey", "tier")


@query("baseline_missing", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def baseline_missing(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("source_completeness", "SELECT c_mktsegment, count(*) AS n, sum(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 1 ELSE 0 END)::BIGINT AS complete FROM customer GROUP BY 1")
def source_completeness(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).distinct()
    return table(spark, sf_dir, "customer").join(seen, F.col("c_custkey") == F.col("k"), "left").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum(F.col("k").isNotNull().cast("int")).alias("complete"))


@query("priority_queue", "SELECT o_orderkey, n FROM (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ORDER BY n DESC, o_orderkey LIMIT 50")
def priority_queue(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_orderkey").limit(50)


@query("pricing_summary", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY 1, 2")
def pricing_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.to_timestamp_ntz(F.lit("1998-09-02 00:00:00")))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("window_tumbling", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def window_tumbling(spark, sf_dir):
    return streams.tumbling(table(spark, sf_dir, "events"), "ts", "1 hour", "event_type").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("window_session", """WITH g AS (SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS s FROM events),
 i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n FROM i GROUP BY user_id, k""")
def window_session(spark, sf_dir):
    return streams.sessions(table(spark, sf_dir, "events"), "ts", "6 hours", "user_id").select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")


@query("text_replay", """WITH d AS (SELECT *, source || '/' || CAST(doc_id // 500 AS VARCHAR) AS work_id, '/' || source || '/rule/' || doc_id AS component_id, doc_id % 3 = 0 AS hit, doc_id % 2 = 0 AS om, substr(text, 1, 40) AS old FROM documents),
 n AS (SELECT *, CASE WHEN om OR old = '' THEN 1 ELSE (length(text) - length(replace(text, old, ''))) // length(old) END AS k FROM d)
 SELECT work_id, component_id, text, DATE '2017-07-01' AS valid_from, CASE WHEN hit AND k = 1 THEN DATE '2020-01-01' END AS valid_to, CAST(NULL AS VARCHAR) AS created_by_event_id, '' AS event_chain, 'version' AS outcome, CAST(NULL AS VARCHAR) AS reason FROM n
 UNION ALL SELECT work_id, component_id, CASE WHEN om THEN '[Omitted]' WHEN old = '' THEN 'In its stead' ELSE replace(text, old, 'In its stead') END, DATE '2020-01-01', NULL, 'e' || doc_id, 'e' || doc_id, 'version', NULL FROM n WHERE hit AND k = 1
 UNION ALL SELECT work_id, component_id, NULL, DATE '2020-01-01', NULL, 'e' || doc_id, '', 'gap', 'several occurrences' FROM n WHERE hit AND k > 1""")
def text_replay(spark, sf_dir):
    from vigora.operators import replay

    # A work has a few dozen documents, however many there are, so that no group grows with the table.
    docs = table(spark, sf_dir, "documents").withColumn("work", F.concat_ws("/", "source", F.floor(F.col("doc_id") / 500)))
    base = docs.select(F.col("work").alias("work_id"), F.concat(F.lit("/"), "source", F.lit("/rule/"), F.col("doc_id").cast("string")).alias("component_id"), "text", F.to_date(F.lit("2017-07-01")).alias("base_date"))
    null = F.lit(None)
    events = docs.where("doc_id % 3 = 0").select(
        F.col("work").alias("work_id"), F.concat(F.lit("e"), F.col("doc_id").cast("string")).alias("event_id"), F.concat(F.lit("/"), "source", F.lit("/rule/"), F.col("doc_id").cast("string")).alias("component_id"), null.cast("string").alias("anchor_id"),
        F.when(F.col("doc_id") % 2 == 0, "OMIT").otherwise("SUBSTITUTE").alias("operation"), F.when(F.col("doc_id") % 2 == 1, F.substring("text", 1, 40)).alias("old_text"), F.lit("In its stead").alias("new_text"),
        null.cast("double").alias("occurrence"), F.lit(False).alias("everywhere"), F.lit(False).alias("before"), F.to_date(F.lit("2020-01-01")).alias("date"), F.col("doc_id").alias("seq"))
    return replay.replay_text(base, events).withColumn("event_chain", F.array_join("event_chain", ">"))


@query("rate_replay", """WITH p AS (SELECT *, p_brand || '/' || CAST(p_partkey // 2000 AS VARCHAR) AS notification, p_partkey % 5 = 0 AS hit, p_partkey % 4 AS k FROM part), r AS (
  SELECT notification, p_type AS schedule_id, p_partkey, 0 AS part, CAST(p_partkey AS VARCHAR) || CASE WHEN hit AND k = 3 THEN 'Z' ELSE '' END AS sno, lpad(CAST(p_size AS VARCHAR), 4, '0') AS tariff_item, CASE WHEN hit AND k = 1 THEN 'new words' ELSE p_name END AS description, hit AND k = 0 AS is_omitted FROM p
  UNION ALL SELECT notification, p_type, p_partkey, 1, p_partkey || 'A', '0101', 'new words', false FROM p WHERE hit AND k = 2)
 SELECT notification, schedule_id, (row_number() OVER (PARTITION BY notification, schedule_id ORDER BY p_partkey, part) - 1)::INTEGER AS pos, sno, tariff_item, description, CAST(NULL AS VARCHAR) AS rate, is_omitted,
 (SELECT count(*) FROM p WHERE p.hit AND p.notification = r.notification)::INTEGER AS n_applied, 0 AS n_failed FROM r WHERE notification IN (SELECT notification FROM p)""")
def rate_replay(spark, sf_dir):
    from vigora.operators import replay

    # A notification has some eighty entries, however many there are.
    part = table(spark, sf_dir, "part").withColumn("notification", F.concat_ws("/", "p_brand", F.floor(F.col("p_partkey") / 2000)))
    base = part.select("notification", F.col("p_type").alias("schedule_id"), F.col("p_partkey").cast("int").alias("pos"), F.col("p_partkey").cast("string").alias("sno"), F.lpad(F.col("p_size").cast("string"), 4, "0").alias("tariff_item"), F.col("p_name").alias("description"), F.lit(False).alias("is_omitted"))
    k, null = F.col("p_partkey") % 4, F.lit(None).cast("string")
    events = part.where("p_partkey % 5 = 0").select(
        "notification", F.col("p_type").alias("schedule_id"), F.when(k == 0, "RATE_OMIT_ENTRIES").when(k == 1, "RATE_SUBSTITUTE_COLUMN").when(k == 2, "RATE_INSERT_ENTRIES").otherwise("RATE_RENUMBER").alias("operation"),
        F.when(k == 2, F.concat(F.col("p_partkey").cast("string"), F.lit("A"))).otherwise(F.col("p_partkey").cast("string")).alias("sno"), F.lit("3").alias("col"), null.alias("old_value"), F.when(k == 3, F.concat(F.col("p_partkey").cast("string"), F.lit("Z"))).otherwise("new words").alias("new_value"),
        F.lit("0101").alias("tariff_item"), F.when(k == 2, F.col("p_partkey").cast("string")).alias("after_sno"), F.to_date(F.lit("2020-01-01")).alias("effective"), F.to_date(F.lit("2020-01-01")).alias("published"), F.col("p_partkey").alias("seq"))
    return replay.replay_rates(base, events)
