"""The review chain over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigora.functions.text import similarity, squeeze
from vigora.operators import review
from vigora.plans.catalog import query
from vigora.sources.readers import table


def joined(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@query("reconciliations_open", """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND o_orderkey % 4 IN (0, 1, 2) AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""")
def reconciliations_open(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    status = F.when(k == 0, "missing_reconstruction").when(k == 1, "true_substantive_mismatch").when(k == 2, "checkpoint_source_incomplete").otherwise("exact")
    outcomes = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("component_id"), F.col("o_orderdate").cast("date").alias("checkpoint_date"), status.alias("status"))
    asked = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("component_id"))
    return review.open_reconciliations(outcomes, asked, F.to_date(F.lit("1996-12-31")), F.to_date(F.lit("1995-01-01"))).select("o_orderkey", F.col("component_id").alias("o_custkey"))


@query("with_confidence", "SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'A' ELSE 'unknown' END AS tier, CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS n_reasons FROM orders")
def with_confidence(spark, sf_dir):
    tiers = table(spark, sf_dir, "orders").where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("component_id")).distinct().select("component_id", F.lit("A").alias("tier"), F.array(F.lit("seen")).alias("reasons"))
    return review.with_confidence(table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "component_id"), tiers).select("o_orderkey", "tier", F.size("reasons").alias("n_reasons"))


@query("cited_chains", """WITH e AS (SELECT user_id, event_id, event_id % 5 <> 0 AND event_id % 11 <> 0 AS ok FROM events)
 SELECT user_id, count(*) AS n_events, coalesce(array_to_string(list_sort(list(event_id) FILTER (NOT ok)), ','), '') AS uncited, bool_and(ok) AS cited FROM e GROUP BY user_id""")
def cited_chains(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    chains = events.groupBy(F.col("user_id").alias("component_id")).agg(F.collect_list("event_id").alias("event_chain"))
    known = events.where("event_id % 11 <> 0").select("event_id", (F.col("event_id") % 5).alias("document_id"))
    made = review.cited_chains(chains, known, spark.range(1, 5).select(F.col("id").alias("document_id")))
    return made.select(F.col("component_id").alias("user_id"), "n_events", joined("uncited").alias("uncited"), "cited")


@query("related_index", "SELECT l_partkey AS related, array_to_string(list_sort(list(DISTINCT l_orderkey)), ',') AS orders FROM lineitem GROUP BY l_partkey")
def related_index(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("parts"))
    return review.by_related(rows, "parts", "l_orderkey").select("related", joined("rows").alias("orders"))


@query("dependencies", """WITH g AS (SELECT l_partkey AS p, count(*) AS n_gaps FROM lineitem WHERE l_quantity < 10 GROUP BY 1), i AS (SELECT l_partkey AS p, count(*) AS n, min(l_orderkey) AS o FROM lineitem WHERE l_quantity > 48 AND l_orderkey % 7 <> 0 GROUP BY 1)
 SELECT g.p AS l_partkey, g.n_gaps, CASE coalesce(i.n, 0) WHEN 1 THEN 'approved' WHEN 0 THEN 'no_candidate_found' ELSE 'ambiguous_candidates' END AS outcome, CASE WHEN i.n = 1 THEN i.o END AS event_id FROM g LEFT JOIN i ON g.p = i.p""")
def dependencies(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("event_id", F.col("l_orderkey"))
    gaps = lines.where("l_quantity < 10").select("event_id", F.col("l_partkey").alias("missing_component_id"))
    made = review.dependencies(gaps, lines.where("l_quantity > 48").select("event_id", F.col("l_partkey").alias("component_id")), lines.where("l_orderkey % 7 = 0"))
    return made.withColumnRenamed("missing_component_id", "l_partkey")


@query("reclassified", "SELECT event_id, CASE WHEN event_type = 'view' AND event_id % 3 = 0 THEN 'RATE_INSERT' ELSE event_type END AS operation FROM events")
def reclassified(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("operation"))
    better = rows.where("event_id % 3 = 0").withColumn("operation", F.lit("RATE_INSERT"))
    return review.replaced(rows, better, "event_id", F.col("operation") == "view")


@query("source_archives", "SELECT sha256(text) AS sha, arg_max(source, doc_id) AS source FROM documents GROUP BY 1")
def source_archives(spark, sf_dir):
    return review.archives(table(spark, sf_dir, "documents").withColumn("sha", F.sha2("text", 256)), "sha", "source", "doc_id")


@query("inventory_errors", """SELECT 'duplicate_id' AS "check", CAST(o_custkey AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1
 UNION ALL SELECT 'count_mismatch', v, n FROM (SELECT coalesce(s.v, f.v) AS v, coalesce(f.n, 0) AS n, coalesce(s.n, 0) AS want FROM (VALUES ('O', 1), ('X', 2)) s(v, n) FULL JOIN (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1) f ON s.v = f.v) WHERE n <> want
 UNION ALL SELECT 'missing_field', 'note', count(*) FROM orders WHERE o_orderkey % 9 = 0""")
def inventory_errors(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("note", F.when(F.col("o_orderkey") % 9 != 0, "x").otherwise(" "))
    return review.inventory_errors(rows, "o_custkey", {"O": 1, "X": 2}, "o_orderstatus", ["note", "o_orderkey"])


@query("slots_allowed", """WITH e AS (SELECT l_partkey, CASE WHEN l_linenumber % 4 = 0 THEN 'INSERT_SIBLING' WHEN l_linenumber % 4 = 1 THEN 'OMIT' ELSE 'SPLICE' END AS op, regexp_replace('n' || l_suppkey % 2 || '-central-tax', '-(central|union|integrated)-tax$', '') AS doc, l_orderkey AS start, l_quantity < 45 AS hashed, l_quantity > 25 AS whole, CAST(l_shipdate AS VARCHAR) AS pub, l_orderkey * 10 + l_linenumber AS o FROM lineitem)
 SELECT l_partkey, count(*) AS n, count(DISTINCT doc) = 1 AND bool_and(op <> 'INSERT_SIBLING') AND count(DISTINCT start) = count(*) AND bool_and(hashed) AS ordered_edits,
 count(*) = 2 AND arg_min(op, o) = 'INSERT_SIBLING' AND arg_max(op, o) = 'OMIT' AND arg_max(whole, o) AND arg_min(pub, o) < arg_max(pub, o) AS insert_then_omit FROM e GROUP BY l_partkey HAVING count(*) > 1""")
def slots_allowed(spark, sf_dir):
    k = F.col("l_linenumber") % 4
    events = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.when(k == 0, "INSERT_SIBLING").when(k == 1, "OMIT").otherwise("SPLICE").alias("operation"), F.concat(F.lit("n"), (F.col("l_suppkey") % 2).cast("string"), F.lit("-central-tax")).alias("document_id"),
        F.col("l_orderkey").alias("start"), F.when(F.col("l_quantity") < 45, "h").alias("text_hash"), (F.col("l_quantity") > 25).alias("whole"), F.col("l_shipdate").cast("date").cast("string").alias("published"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order"))
    return review.slots_allowed(events, "l_partkey")


@query("review_groups", """SELECT user_id, count(*) AS n, array_to_string(list(event_id ORDER BY event_id), ',') AS items, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS reasons, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def review_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.array("event_type").alias("reasons"), F.col("event_id").alias("o"), "event_type")
    return review.grouped(rows, "user_id", "event_id", "reasons", "o", "event_type").select("user_id", "n", joined("items").alias("items"), joined("reasons").alias("reasons"), "event_type")


@query("most_gaps", """SELECT l_suppkey, count(*) AS n_gaps, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY l_suppkey ORDER BY count(*) DESC, l_suppkey LIMIT 10""")
def most_gaps(spark, sf_dir):
    return review.most_gaps(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_returnflag").select("l_suppkey", "n_gaps", F.coalesce(F.try_element_at("lanes", F.lit("R")), F.lit(0)).alias("returned"))


@query("entry_sources", """WITH n AS (SELECT p_type AS schedule, upper(p_brand) AS sno, p_size AS source, p_partkey AS seq FROM part UNION ALL SELECT p_type, 'L' || p_size % 4, p_size, p_partkey FROM part),
 f AS (SELECT schedule, sno, source, min(seq) AS seq FROM n GROUP BY 1, 2, 3) SELECT schedule, sno, array_to_string(list(source ORDER BY seq), ',') AS sources FROM f GROUP BY 1, 2""")
def entry_sources(spark, sf_dir):
    size = F.col("p_size").cast("string")
    events = table(spark, sf_dir, "part").select(F.col("p_type").alias("schedule"), F.concat("p_brand", F.lit(".")).alias("sno"), F.array(F.concat(F.lit("l"), (F.col("p_size") % 4).cast("string"), F.lit("."))).alias("sno_list"), size.alias("source"), F.col("p_partkey").alias("seq"))
    return review.sources_of_entries(events).select("schedule", "sno", joined("sources").alias("sources"))


@query("base_at_date", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) >= DATE '1997-01-01' THEN 'P' ELSE o_orderstatus END AS active, CASE WHEN o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) >= DATE '1997-01-01' THEN 'base P' WHEN o_orderstatus IN ('O', 'P') THEN 'base ' || o_orderstatus ELSE '' END AS base FROM orders""")
def base_at_date(spark, sf_dir):
    asked = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("notification"), review.filter_date(F.concat(F.lit("svc_"), F.col("o_orderdate").cast("date").cast("string"))).alias("date"))
    bases = spark.createDataFrame([("O", "base O"), ("P", "base P")], "notification string, base string")
    return review.base_at(asked, bases, spark.createDataFrame([("O", "P", "1997-01-01")], "notification string, successor string, since string")).select("o_orderkey", "active", "base")


@query("instrument_at", """WITH r AS (SELECT user_id, event_id, ts FROM events WHERE event_id % 4 <> 0 AND event_id % 9 <> 0) SELECT user_id, arg_max('n' || event_id, (CASE WHEN ts <= TIMESTAMP '2024-01-10' THEN 1 ELSE 0 END, ts, event_id)) AS instrument FROM r GROUP BY user_id""")
def instrument_at(spark, sf_dir):
    e = F.col("event_id")
    doc = F.when(e % 4 == 0, "derived/x").when(e % 9 == 0, "").otherwise(F.concat(F.lit("n"), e.cast("string")))
    rows = table(spark, sf_dir, "events").select("user_id", doc.alias("doc"), F.struct("ts", "event_id").alias("start"))
    return review.instrument_at(rows, "user_id", "doc", "start", F.struct(F.to_timestamp_ntz(F.lit("2024-01-10 00:00:00")).alias("ts"), F.lit((1 << 62)).alias("event_id")))


@query("unreviewed_candidates", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'proposed' ELSE 'open' END AS status FROM events WHERE event_id % 4 IN (2, 3)")
def unreviewed_candidates(spark, sf_dir):
    k = F.col("event_id") % 4
    return review.unreviewed(table(spark, sf_dir, "events").select("event_id", F.when(k == 0, "accepted").when(k == 1, "validated").when(k == 2, "open").alias("status")), "status")


@query("corpus_errors", """SELECT 'duplicate_id' AS "check", CAST(o_custkey AS VARCHAR) AS value FROM orders GROUP BY o_custkey HAVING count(*) > 1 UNION ALL SELECT 'path_mismatch', 'x' || o_orderkey FROM orders WHERE o_orderkey % 13 = 0
 UNION ALL SELECT DISTINCT 'unresolved_reference', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def corpus_errors(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    docs = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id"), F.concat(F.when(F.col("o_orderkey") % 13 == 0, "x").otherwise("p"), key).alias("path"), F.concat(F.lit("p"), key).alias("expected_path"))
    return review.corpus_errors(docs, table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("target")))


@query("manifest_errors", """SELECT c_custkey AS work_id, c_custkey % 3 AS n_gaps, coalesce(n, 0) AS found FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE c_custkey % 3 <> coalesce(n, 0)""")
def manifest_errors(spark, sf_dir):
    manifest = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("work_id"), (F.col("c_custkey") % 3).alias("n_gaps"))
    return review.manifest_errors(manifest, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("work_id")))


@query("flattened_versions", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id)::INTEGER AS version_no FROM events")
def flattened_versions(spark, sf_dir):
    return review.flattened(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id")


@query("missing_targets", "SELECT o_orderkey, '/rule/' || o_custkey AS target FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)")
def missing_targets(spark, sf_dir):
    cust = F.col("o_custkey").cast("string")
    events = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("/rule/"), cust)).otherwise(cust).alias("target"))
    known = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.concat(F.lit("/rule/"), F.col("c_custkey").cast("string")).alias("component_id"))
    return review.missing_targets(events, known, "^/rule/").select("o_orderkey", "target")


@query("minor_differences", "SELECT p_partkey, p_partkey % 3 = 0 AS minor FROM part")
def minor_differences(spark, sf_dir):
    k, name = F.col("p_partkey") % 3, F.col("p_name")
    other = F.when(k == 0, F.regexp_replace(F.upper(name), " ", " - ")).when(k == 1, name).otherwise(F.concat(name, F.lit(" and words that nobody had there before this one came")))
    rows = table(spark, sf_dir, "part").select("p_partkey", squeeze(name).alias("a"), squeeze(other).alias("b"), k.alias("k"))
    rows = rows.withColumn("deep", similarity("a", "b"))
    return rows.select("p_partkey", review.minor_difference(F.col("a"), F.col("b"), F.when(F.col("k") == 1, 1.0).otherwise(0.7), F.col("deep"), (0.6, 0.8), (0.9, 1.1), 0.95).alias("minor"))
