"""Ids, baselines, spans, verdicts and parsed records over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigora.functions import codes, ids, text as tx
from vigora.operators import baseline, quality, search
from vigora.plans.catalog import query
from vigora.sources import parsing, readers, render
from vigora.sources.readers import table

PATH = "'/in/union/' || CASE n_regionkey % 4 WHEN 0 THEN 'acts' WHEN 1 THEN 'rules' WHEN 2 THEN 'forms' ELSE 'notifications' END || '/x-' || n_nationkey || CASE n_regionkey % 4 WHEN 0 THEN '/section/0' || n_nationkey || 'a/subsection/2' WHEN 1 THEN '/rule/' || n_nationkey ELSE '' END"


def path():
    r, n = F.col("n_regionkey") % 4, F.col("n_nationkey").cast("string")
    kind = F.when(r == 0, "acts").when(r == 1, "rules").when(r == 2, "forms").otherwise("notifications")
    tail = F.when(r == 0, F.concat(F.lit("/section/0"), n, F.lit("a/subsection/2"))).when(r == 1, F.concat(F.lit("/rule/"), n)).otherwise("")
    return F.concat(F.lit("/in/union/"), kind, F.lit("/x-"), n, tail)


@query("id_parts", f"""WITH p AS (SELECT n_nationkey, n_regionkey % 4 AS r, {PATH} AS id FROM nation) SELECT n_nationkey, CASE r WHEN 0 THEN 'act_section' WHEN 1 THEN 'rule' WHEN 2 THEN 'form' ELSE 'notification' END AS kind,
 CASE WHEN contains(id, '/rule/') THEN split_part(id, '/rule/', 1) WHEN contains(id, '/section/') THEN split_part(id, '/section/', 1) END AS work, CASE WHEN contains(id, '/subsection/') THEN split_part(id, '/subsection/', 1) END AS parent,
 array_to_string(string_split(id, '/')[1:CASE r WHEN 3 THEN 8 ELSE 5 END], '/') AS document, CASE WHEN r = 0 THEN replace(id, '/section/0' || n_nationkey || 'a', '/section/' || n_nationkey || 'A') ELSE id END AS normalised FROM p""")
def id_parts(spark, sf_dir):
    made = table(spark, sf_dir, "nation").withColumn("id", path())
    return made.select("n_nationkey", ids.kind_of("id").alias("kind"), ids.work_of("id").alias("work"), ids.parent_of("id").alias("parent"), ids.document_of("id").alias("document"), ids.normalised_component("id").alias("normalised"))


@query("id_slugs", r"SELECT p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug, regexp_replace(p_brand, '[^A-Za-z0-9_.-]+', '_', 'g') AS eid, upper(replace(p_name, ' ', '_')) AS rel FROM part")
def id_slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", ids.slug(F.concat_ws(" / ", "p_name", "p_brand")).alias("slug"), ids.safe_eid("p_brand").alias("eid"), ids.relationship("p_name").alias("rel"))


@query("path_overlaps", f"""WITH p AS (SELECT n_nationkey, {PATH} AS id FROM nation), q AS (SELECT id || '/x' AS id FROM p WHERE n_nationkey % 2 = 0) SELECT p.n_nationkey, count(*) AS n FROM p JOIN q ON starts_with(q.id, p.id || '/') GROUP BY 1""")
def path_overlaps(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select("n_nationkey", path().alias("component_id"))
    below = rows.where("n_nationkey % 2 = 0").select(F.concat("component_id", F.lit("/x")).alias("t"))
    hits = baseline.blocked_targets(below, rows, "t").where("blocked_by IS NOT NULL")
    return hits.join(rows, F.col("blocked_by") == F.col("component_id")).groupBy("n_nationkey").agg(F.count("*").alias("n"))


@query("event_ids", "SELECT event_id, 'evt_cbx_' || substr(sha256(concat_ws('|', event_type, CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), sha256(props))), 1, 16) AS id FROM events")
def event_ids(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", ids.event_id("cbx", F.col("event_type"), F.col("user_id"), F.col("event_id"), tx.text_hash("props")).alias("id"))


@query("legal_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def legal_dates(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    day = F.col("o_orderdate")
    said = F.when(k == 0, F.concat(F.lit("with effect from the "), F.dayofmonth(day).cast("string"), F.lit("th day of "), F.date_format(day, "MMMM"), F.lit(", "), F.year(day).cast("string"))).when(k == 1, F.date_format(day, "'dated' dd.MM.yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").withColumn("said", said).select("o_orderkey", ids.legal_date("said").alias("d"))


@query("baseline_flags", r"SELECT doc_id, array_to_string(list_filter([CASE WHEN trim(text) = '' THEN 'empty' END, CASE WHEN regexp_matches(text, '\.{5,}') THEN 'dot_leaders' END, CASE WHEN lang = 'en' THEN 'no_label' END], lambda x: x IS NOT NULL), ',') AS flags FROM documents")
def baseline_flags(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(baseline.flags(F.col("text"), F.when(F.col("lang") != "en", F.col("lang"))), ",").alias("flags"))


@query("baseline_repair", "SELECT doc_id, CASE WHEN doc_id >= 100 THEN 'unchanged' WHEN doc_id % 4 = 0 THEN 'repaired' WHEN doc_id % 4 = 1 THEN 'replacement_rejected' ELSE 'unchanged' END AS repair FROM documents")
def baseline_repair(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("component_id"), F.lit("l").alias("label"), "text")
    source = docs.withColumn("text", F.when(F.col("component_id") % 4 == 0, F.concat(F.lit("Amended: "), F.col("component_id").cast("string"))).when(F.col("component_id") % 4 == 1, "").otherwise(F.col("text")))
    return baseline.repair(docs, source, F.col("component_id") < 100).select(F.col("component_id").alias("doc_id"), "repair")


@query("baseline_tracks", "SELECT doc_id, doc_id % 5 = 0 AND doc_id % 7 <> 0 AS blocked FROM documents")
def baseline_tracks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("component_id"), "text")
    second = docs.where("component_id % 7 <> 0").withColumn("text", F.when(F.col("component_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return baseline.tracks(docs, second).select(F.col("component_id").alias("doc_id"), "blocked")


@query("span_errors", "SELECT doc_id, pos, CASE pos WHEN 1 THEN 'overlap,hash_mismatch' ELSE 'out_of_bounds,hash_mismatch' END AS errors FROM documents, (SELECT unnest([1, 2]) AS pos) WHERE length(text) > 40 AND doc_id % 3 = 0")
def span_errors(spark, sf_dir):
    span = lambda a, b, h: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), h.alias("text_hash"))
    rows = table(spark, sf_dir, "documents").where((F.length("text") > 40) & (F.col("doc_id") % 3 == 0)).withColumn("s", F.array(span(0, 10, F.sha2(F.substring("text", 1, 10), 256)), span(5, 20, F.lit("x")), span(30, 10_000_000, F.lit("y"))))
    return quality.span_errors(rows, "doc_id", "text", "s").select("doc_id", "pos", F.array_join("errors", ",").alias("errors"))


@query("verdicts", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'failed_verification' WHEN o_custkey % 5 = 0 OR o_custkey % 7 = 0 THEN 'ok_with_gaps' WHEN o_totalprice > 400000 THEN 'exact_with_formatting_debt' ELSE 'exact' END AS verdict, array_to_string(list_filter([CASE WHEN o_custkey % 5 = 0 THEN 'gaps' END, CASE WHEN o_custkey % 7 = 0 THEN 'tier' END], lambda x: x IS NOT NULL), ',') AS blocking FROM orders")
def verdicts(spark, sf_dir):
    made = quality.verdict(F.when(F.col("o_orderstatus") == "F", "not_found").otherwise("ok"), [("gaps", F.col("o_custkey") % 5 != 0), ("tier", F.col("o_custkey") % 7 != 0)], F.col("o_totalprice") > 400000)
    return table(spark, sf_dir, "orders").withColumn("v", made).select("o_orderkey", "v.verdict", F.array_join("v.blocking", ",").alias("blocking"))


@query("reconciliation_outcomes", """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'post_checkpoint' WHEN doc_id % 10 = 0 THEN 'omitted_correct' WHEN doc_id % 11 = 0 THEN 'missing_reconstruction' WHEN doc_id % 4 = 0 THEN 'exact' WHEN doc_id % 4 = 1 THEN 'format_only'
 WHEN length(text) < 20 OR (length(text) + 400) / length(text) > 3 THEN 'comparison_invalid' ELSE 'true_substantive_mismatch' END AS outcome FROM documents WHERE text <> '' AND trim(text) <> ''""")
def reconciliation_outcomes(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("text <> '' AND trim(text) <> ''")
    k = F.col("doc_id")
    missing = (k % 9 == 0) | (k % 10 == 0) | (k % 11 == 0)
    mine = F.when(k % 4 == 0, F.col("text")).when(k % 4 == 1, F.concat("text", F.lit(" !"))).otherwise(F.concat("text", F.repeat(F.lit("abcd"), 100)))
    made = quality.outcome(mine, ~missing, k % 9 == 0, k % 10 == 0, F.col("text"), F.lit(0.5), (k % 4 == 1), F.lit(False))
    return rows.select("doc_id", made.alias("outcome"))


@query("typed_codes", "SELECT p_partkey, 'chapter:' || lpad(CAST(p_size AS VARCHAR), 2, '0') || ',hsn:' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS codes FROM part")
def typed_codes(spark, sf_dir):
    cell = F.concat(F.lit("Chapter "), F.col("p_size").cast("string"), F.lit("; "), F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lit(" / junk]"))
    return table(spark, sf_dir, "part").withColumn("c", codes.typed_codes(cell)).select("p_partkey", F.array_join(F.transform("c", lambda x: F.concat_ws(":", x.kind, x.code)), ",").alias("codes"))


@query("page_offsets", "SELECT conv_id, turn, (coalesce(sum(length(text) + 2) OVER w, 0))::BIGINT AS start FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def page_offsets(spark, sf_dir):
    return readers.pages(table(spark, sf_dir, "conversations"), "conv_id", "text", "turn").select("conv_id", "turn", "start")


@query("rendered_xml", "SELECT item_id, '<p id=\"' || item_id || '\">' || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') || '</p>' AS xml FROM benchmark")
def rendered_xml(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", render.element("p", render.escaped(F.col("text")), id=F.col("item_id")).alias("xml"))


@query("contamination_semi", "SELECT DISTINCT d.doc_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def contamination_semi(spark, sf_dir):
    """Documents that hold a whole benchmark passage."""
    return search.holding(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "text")


@query("structure_blocks")
def structure_blocks(spark, sf_dir):
    return parsing.structure(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("rate_table_parse", "SELECT p_brand || '/' || CAST(p_partkey // 2000 AS VARCHAR) AS notification, 'I' AS schedule_id, CAST(2.5 AS DOUBLE) AS rate, (row_number() OVER (PARTITION BY p_brand, p_partkey // 2000 ORDER BY p_partkey) - 1)::INTEGER AS pos, CAST(p_partkey + 1 AS VARCHAR) AS sno, lpad(CAST(p_size AS VARCHAR), 4, '0') AS tariff_item, p_name AS description, false AS is_omitted FROM part")
def rate_table_parse(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    line = F.concat((F.col("p_partkey") + 1).cast("string"), F.lit(". "), F.lpad(F.col("p_size").cast("string"), 4, "0"), F.lit(" "), "p_name")
    lines = part.groupBy(F.concat_ws("/", "p_brand", F.floor(F.col("p_partkey") / 2000)).alias("notification")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("l")))), lambda x: x.l), "\n").alias("text"))
    return parsing.rate_tables(lines.withColumn("text", F.concat(F.lit("Schedule I - 2.5%\n"), "text")))
