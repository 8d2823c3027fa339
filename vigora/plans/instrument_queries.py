"""Instruments, locators, effects and concessions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigora.functions import instruments as ins
from vigora.operators import graph, rates
from vigora.plans.catalog import query
from vigora.plans.graph_queries import EDGES, NODES, edges, nodes
from vigora.sources.readers import table


@query("instrument_parts", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS number, CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders""")
def instrument_parts(spark, sf_dir):
    k, cust = F.col("o_orderkey") % 3, F.col("o_custkey").cast("string")
    year = F.year("o_orderdate").cast("string")
    text = F.when(k == 0, F.concat(F.lit("No. 0"), cust, F.lit(" / "), year)).when(k == 1, F.concat(F.lit("Circular "), cust)).otherwise("none")
    return table(spark, sf_dir, "orders").select("o_orderkey", ins.instrument_parts(text, "o_orderdate", "o_orderkey").alias("p")).select("o_orderkey", "p.number", "p.year")


@query("notification_ids", """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '/in/n/c' || (p_size % 5) || '/2017/corrigendum-' || p_partkey ELSE '/in/n/c' || (p_size % 5) || '/2017/' || p_size || '-2017' END AS document,
 p_size || '/2017' || CASE p_size % 3 WHEN 0 THEN '-ct-rate' WHEN 1 THEN '-cc-rate' ELSE '' END AS short FROM part""")
def notification_ids(spark, sf_dir):
    size = F.col("p_size").cast("string")
    parts = ins.instrument_parts(F.concat(size, F.lit("/2017")), F.lit("2016-01-01"), "p_partkey")
    category = F.concat(F.lit("c"), (F.col("p_size") % 5).cast("string"))
    folder = F.when(F.col("p_size") % 3 == 0, "central-tax-rate").when(F.col("p_size") % 3 == 1, "compensation-cess-rate").otherwise("customs")
    path = F.concat(F.lit("/in/"), folder, F.lit("/2017/"), size, F.lit("-2017-x"))
    return table(spark, sf_dir, "part").select("p_partkey", ins.notification_document("/in/n", category, parts, F.col("p_partkey") % 7 == 0, "p_partkey").alias("document"), ins.short_notification(path).alias("short"))


@query("rate_locators", """SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN p_brand WHEN p_brand = 'Brand#11' THEN p_brand END AS target, CASE WHEN p_partkey % 4 = 2 THEN 'IV' END AS schedule, CASE WHEN p_partkey % 4 = 0 THEN lpad(CAST(p_size AS VARCHAR), 4, '0') END AS code, CASE WHEN p_partkey % 4 IN (1, 2) THEN p_size || 'A' END AS serial FROM part""")
def rate_locators(spark, sf_dir):
    k, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    spec = F.when(k == 0, F.concat(F.lit("::hsn="), F.lpad(size, 4, "0"), F.lit("@2024-01-01"))).when(k == 1, F.concat(F.lit("::sno="), size, F.lit("A"))).when(k == 2, F.concat(F.lit("::schedule=IV,sno="), size, F.lit("A"))).otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", ins.rate_locator(F.concat("p_brand", spec), ["Brand#11"]).alias("l")).select("p_partkey", "l.*")


@query("families_of_operations", "SELECT CASE p_size % 5 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'INSERT' WHEN 2 THEN 'TEXT_EDIT' WHEN 3 THEN 'TEXT_EDIT' ELSE 'OMIT' END AS family, count(*) AS n FROM part GROUP BY 1")
def families_of_operations(spark, sf_dir):
    k = F.col("p_size") % 5
    op = F.when(k == 0, "INSERT_CHILD").when(k == 1, "INSERT_SIBLING").when(k == 2, "SPLICE").when(k == 3, "SUBSTITUTE").otherwise("OMIT")
    return table(spark, sf_dir, "part").groupBy(ins.operation_family(op).alias("family")).agg(F.count("*").alias("n"))


@query("notification_refs", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE lpad(CAST(c_custkey % 1000 AS VARCHAR), greatest(2, length(CAST(c_custkey % 1000 AS VARCHAR)))::INTEGER, '0') || '/2019' END AS ref FROM customer")
def notification_refs(spark, sf_dir):
    k, n = F.col("c_custkey") % 3, (F.col("c_custkey") % 1000).cast("string")
    first = F.when(k == 0, F.concat(F.lit("No. "), n, F.lit("/2019"))).otherwise("")
    second = F.when(k == 1, F.concat(F.lit("/in/n/"), n, F.lit("-2019"))).otherwise("12345/20199")
    return table(spark, sf_dir, "customer").select("c_custkey", ins.notification_ref(first, second).alias("ref"))


@query("form_labels", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'gstreg-' || n_nationkey ELSE 'gst-reg-' || n_nationkey END AS label FROM nation")
def form_labels(spark, sf_dir):
    n = F.col("n_nationkey").cast("string")
    return table(spark, sf_dir, "nation").select("n_nationkey", ins.form_label(F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("GST REG "), n)).otherwise(F.concat(F.lit("GST - Reg - "), n, F.lit("*")))).alias("label"))


@query("legal_differences", "SELECT count(*) FILTER (d) AS differ, count(*) FILTER (NOT d) AS alike FROM (SELECT o_orderkey % 6 IN (1, 2, 3, 4) AS d FROM orders)")
def legal_differences(spark, sf_dir):
    k = F.col("o_orderkey") % 6
    base = F.concat(F.lit("Rule 5 of 2017 on 1,00,000 at 5 per cent "), "o_comment" if "o_comment" in table(spark, sf_dir, "orders").columns else "o_orderpriority")
    other = F.when(k == 1, F.replace(base, F.lit("Rule 5"), F.lit("Rule 6"))).when(k == 2, F.replace(base, F.lit("2017"), F.lit("2018"))).when(k == 3, F.replace(base, F.lit("1,00,000"), F.lit("2,00,000"))).when(k == 4, F.replace(base, F.lit("5 per cent"), F.lit("ten per cent"))).otherwise(F.concat(base, F.lit(" more words")))
    d = ins.legal_difference(base, other)
    return table(spark, sf_dir, "orders").agg(F.count(F.when(d, 1)).alias("differ"), F.count(F.when(~d, 1)).alias("alike"))


@query("same_substance", "SELECT p_partkey, p_partkey % 4 IN (0, 1) AS same FROM part")
def same_substance(spark, sf_dir):
    k, name = F.col("p_partkey") % 4, F.col("p_name")
    other = F.when(k == 0, F.upper(name)).when(k == 1, F.concat(F.lit("Rule 7A. "), name)).when(k == 2, F.concat(F.lit("Other start "), name)).otherwise(F.concat(name, F.lit(" and more")))
    return table(spark, sf_dir, "part").select("p_partkey", ins.same_substance(name, other, F.lit("7A")).alias("same"))


@query("clause_effects", "SELECT o_orderkey, o_orderkey % 4 = 0 AS metadata_only, o_orderkey % 4 = 2 AS schedule FROM orders")
def clause_effects(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, "Notification issued earlier shall have RETROSPECTIVE effect").when(k == 1, "Notification issued earlier: words shall be inserted retrospectively").when(k == 2, "Amendment of Schedule II").otherwise("Notification issued on schedule III, retrospectively")
    return table(spark, sf_dir, "orders").select("o_orderkey", ins.metadata_only_effect(text).alias("metadata_only"), ins.schedule_effect(text).alias("schedule"))


@query("commencement_blocked", "SELECT event_id, event_type = 'signup' OR event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0 AS blocked FROM events")
def commencement_blocked(spark, sf_dir):
    e = F.col("event_id")
    op = F.when(F.col("event_type") == "signup", "COMMENCE").otherwise("OMIT")
    made = ins.commencement_blocked(op, F.when(e % 5 == 0, F.array(F.lit("date_not_resolved"))), F.when(e % 7 == 0, "commencement_only"), F.when(e % 11 == 0, F.array(F.lit("unresolved_commencement"))))
    return table(spark, sf_dir, "events").select("event_id", made.alias("blocked"))


@query("section_scores", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 200 WHEN 1 THEN 75 ELSE 0 END + CASE WHEN length(text) + CASE doc_id % 3 WHEN 0 THEN 11 WHEN 1 THEN 24 ELSE 0 END > 250 THEN 25 ELSE 0 END AS score FROM documents WHERE NOT regexp_matches(text, '(?i)section|inserted|substituted|omitted|vide notification|finance act')")
def section_scores(spark, sf_dir):
    k = F.col("doc_id") % 3
    text = F.concat(F.when(k == 0, "Section 9A ").when(k == 1, "(section 9A) inserted, ").otherwise(""), F.when(k == 1, " ").otherwise(""), "text")
    docs = table(spark, sf_dir, "documents").where(~F.col("text").rlike("(?i)section|inserted|substituted|omitted|vide notification|finance act"))
    return docs.select("doc_id", ins.section_score("9A", text).alias("score"))


@query("event_dates", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE '' END AS d FROM orders")
def event_dates(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    return table(spark, sf_dir, "orders").select("o_orderkey", ins.event_date(F.when(k == 0, "a").otherwise(""), F.when(k == 1, "b"), F.lit("")).alias("d"))


@query("gap_filled", """WITH c AS (SELECT DISTINCT p_type AS s, substr(lpad(CAST(p_partkey AS VARCHAR), 6, '0'), 1, 4) AS p FROM part WHERE p_partkey % 3 = 0)
 SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'exact' WHEN EXISTS (SELECT 1 FROM c WHERE c.s = p_type AND c.p = substr(lpad(CAST(p_partkey AS VARCHAR), 6, '0'), 1, 4)) THEN 'concordance_traced' ELSE 'missing_in_materialised' END AS class FROM part""")
def gap_filled(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("code", F.lpad(F.col("p_partkey").cast("string"), 6, "0")).withColumn("schedule", F.col("p_type"))
    report = part.withColumn("class", F.when(F.col("p_partkey") % 2 == 0, "exact").otherwise("missing_in_materialised"))
    known = part.where("p_partkey % 3 = 0").select(F.col("schedule").alias("pre_schedule"), F.col("code").alias("pre_code"))
    return rates.gap_fill(report, known).select("p_partkey", "class")


@query("concessions", """SELECT l.l_orderkey, l.l_linenumber, p.p_partkey, CASE WHEN p.p_size % 5 = 0 THEN 'exemption' ELSE 'concession' END AS kind, (p.p_size % 5) * 2 AS total_rate, 'opening ' || p.p_brand AS opening FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey AND (p.p_size % 2 = 0 OR l.l_shipdate >= DATE '1995-01-01')""")
def concessions(spark, sf_dir):
    asked = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("code"), F.col("l_shipdate").cast("date").alias("date"))
    part = table(spark, sf_dir, "part")
    entries = part.select(F.col("p_partkey").alias("code"), "p_partkey", F.col("p_brand").alias("notification"), F.lit("I").alias("schedule"), (F.col("p_size") % 5).alias("rate"), F.when(F.col("p_size") % 2 == 1, F.lit("1995-01-01")).cast("date").alias("effective"))
    opening = part.select(F.col("p_brand").alias("notification"), F.lit("I").alias("schedule"), F.concat(F.lit("opening "), "p_brand").alias("opening")).distinct()
    return rates.conditions(rates.concessions(asked, entries), opening).select("l_orderkey", "l_linenumber", "p_partkey", "kind", "total_rate", "opening")


@query("post_entry", "SELECT p_partkey, p_name FROM part WHERE p_type = (SELECT p_type FROM part WHERE p_partkey = 7) AND p_partkey = 7")
def post_entry(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_type").alias("pre_schedule"), F.col("p_partkey").cast("string").alias("pre_sno"))
    kind = part.where("p_partkey = 7").select(F.col("pre_schedule").alias("_kind"))
    return rates.post_entry(part.join(kind, F.col("pre_schedule") == F.col("_kind"), "left_semi"), F.col("pre_schedule"), F.lit("7.")).select("p_partkey", "p_name")


@query("forms_of_rule", f"""WITH e AS ({EDGES}), held AS (SELECT '/region/1' AS id UNION SELECT target FROM e WHERE source = '/region/1')
 SELECT target, min(source) AS source FROM e JOIN held ON e.source = held.id WHERE target LIKE '/supplier/%' GROUP BY target ORDER BY target LIMIT 50""")
def forms_of_rule(spark, sf_dir):
    # The parts of a rule have its path: nations are moved below their regions for it.
    named = edges(spark, sf_dir)
    parts = named.where("source = '/region/1'").select(F.col("target").alias("_part"))
    below = named.join(parts, F.col("source") == F.col("_part"), "left").withColumn("source", F.when(F.col("_part").isNotNull(), F.concat(F.lit("/region/1"), F.col("source"))).otherwise(F.col("source")))
    below = below.withColumn("target", F.when(F.col("source") == "/region/1", F.concat(F.lit("/region/1"), F.col("target"))).otherwise(F.col("target"))).withColumn("type", F.when(F.col("source") == "/region/1", "CONTAINS").otherwise(F.col("type")))
    made = graph.forms_of(below.select("source", "target", "type"), F.lit("/region/1"), "/supplier/")
    return made.select("target", F.regexp_replace("source", "^/region/1(?=/)", "").alias("source"))


@query("edge_payloads", f"""WITH e AS ({EDGES}), n AS ({NODES}) SELECT e.source, e.target, a.label AS source_label, b.label AS target_label FROM e LEFT JOIN n a ON a.id = e.source LEFT JOIN n b ON b.id = e.target""")
def edge_payloads(spark, sf_dir):
    known = nodes(spark, sf_dir)
    every = known[0]
    for more in known[1:]:
        every = every.unionByName(more)
    return graph.with_nodes(edges(spark, sf_dir), every, "label").select("source", "target", "source_label", "target_label")


@query("alias_lookup", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n_name WHEN c_custkey % 3 = 1 THEN n_name END AS resolved FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def alias_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    k = F.col("c_custkey") % 3
    values = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.when(k == 0, F.col("n_name")).when(k == 1, F.concat(F.lit(" State  of "), F.upper("n_name"))).otherwise("shared").alias("value"))
    aliases = nation.select(F.concat(F.lit("state of "), "n_name").alias("alias"), F.col("n_name").alias("work_id")).unionByName(nation.select(F.lit("Shared").alias("alias"), F.col("n_name").alias("work_id")))
    return graph.by_alias(values, "value", nation.select(F.col("n_name").alias("work_id")), aliases).select("c_custkey", "resolved")
