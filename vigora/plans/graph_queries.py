"""Graphs from foreign keys and page links, and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigora.functions.ids import relationship
from vigora.operators import graph, vector
from vigora.plans.catalog import query
from vigora.sources.readers import table

PARTS = [("region", "r_regionkey", "r_name", None), ("nation", "n_nationkey", "n_name", ("region", "n_regionkey")), ("supplier", "s_suppkey", "s_name", ("nation", "s_nationkey")), ("customer", "c_custkey", "c_name", ("nation", "c_nationkey"))]


def nodes(spark, sf_dir):
    return [table(spark, sf_dir, t).select(F.concat(F.lit(f"/{t}/"), F.col(k).cast("string")).alias("id"), F.lit(t).alias("kind"), F.col(n).alias("label")) for t, k, n, _ in PARTS]


def edges(spark, sf_dir):
    made = None
    for t, k, _, up in PARTS:
        if up:
            part = table(spark, sf_dir, t).select(F.concat(F.lit(f"/{up[0]}/"), F.col(up[1]).cast("string")).alias("source"), F.concat(F.lit(f"/{t}/"), F.col(k).cast("string")).alias("target"), F.lit(f"has {t}").alias("type"))
            made = part if made is None else made.unionByName(part)
    return made


EDGES = " UNION ALL ".join(f"SELECT '/{up[0]}/' || {up[1]} AS source, '/{t}/' || {k} AS target, 'has {t}' AS type FROM {t}" for t, k, _, up in PARTS if up)
NODES = " UNION ALL ".join(f"SELECT '/{t}/' || {k} AS id, '{t}' AS kind, {n} AS label FROM {t}" for t, k, n, _ in PARTS)


@query("graph_nodes", f"SELECT id, array_to_string(list_sort(list(DISTINCT kind)), '+') AS kind, min(label) AS label FROM ({NODES}) GROUP BY id")
def graph_nodes(spark, sf_dir):
    return graph.nodes(nodes(spark, sf_dir)).select("id", "kind", "label")


@query("graph_edges", f"SELECT DISTINCT source, target, upper(replace(type, ' ', '_')) AS type FROM ({EDGES})")
def graph_edges(spark, sf_dir):
    return graph.edges(edges(spark, sf_dir).withColumn("type", relationship("type")))


@query("merge_statements", f"SELECT upper(replace(type, ' ', '_')) AS type, count(*) AS n FROM ({EDGES}) GROUP BY 1")
def merge_statements(spark, sf_dir):
    return graph.statements(edges(spark, sf_dir), relationship("type")).select("type", "n")


@query("outgoing_refs", f"SELECT source, target FROM ({EDGES}) WHERE source = '/nation/3' ORDER BY source, target, type LIMIT 50")
def outgoing_refs(spark, sf_dir):
    return graph.neighbours(edges(spark, sf_dir), F.lit("/nation/3"), "source").select("source", "target")


@query("incoming_refs", f"SELECT source, target FROM ({EDGES}) WHERE target = '/nation/3' ORDER BY source, target, type LIMIT 50")
def incoming_refs(spark, sf_dir):
    return graph.neighbours(edges(spark, sf_dir), F.lit("/nation/3"), "target").select("source", "target")


@query("bounded_paths", f"""WITH RECURSIVE e AS ({EDGES}), w(depth, node, path) AS (SELECT 1, target, source || '>' || target FROM e WHERE source = '/region/1' UNION ALL SELECT w.depth + 1, e.target, w.path || '>' || e.target FROM w JOIN e ON e.source = w.node WHERE w.depth < 3)
, l AS (SELECT depth, node, min(path) AS path FROM w GROUP BY depth, node)
 SELECT depth, node, path FROM w WHERE depth = 1 UNION ALL SELECT l.depth + 1, e.target, l.path || '>' || e.target FROM l JOIN e ON e.source = l.node WHERE l.depth < 3""")
def bounded_paths(spark, sf_dir):
    return graph.paths(edges(spark, sf_dir), F.lit("/region/1"), 3).select("depth", "node", F.array_join("path", ">").alias("path"))


LINKS = """SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS target FROM pages"""


def links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), F.lit(1))).alias("target"))


@query("link_edges", f"SELECT DISTINCT page_id, target FROM ({LINKS})")
def link_edges(spark, sf_dir):
    return graph.edges(links(spark, sf_dir), "page_id", "target")


KNOWN = "SELECT DISTINCT '/' || lower(substr(target, 2)) AS id FROM x WHERE page_id % 3 = 0"


@query("reference_resolution", f"""WITH x AS ({LINKS}), r AS (SELECT page_id, '/in/' || lower(substr(target, 2)) AS target FROM x), k AS (SELECT DISTINCT target AS id FROM r WHERE page_id % 3 = 0),
 a AS (SELECT DISTINCT target AS alias, target || '-act' AS id FROM r WHERE page_id % 3 = 1)
 SELECT r.page_id, r.target, CASE WHEN k.id IS NOT NULL THEN 'resolved' WHEN a.alias IS NOT NULL THEN 'alias_document_exists_child_missing' ELSE 'document_missing' END AS status
 FROM r LEFT JOIN k ON r.target = k.id LEFT JOIN a ON r.target = a.alias""")
def reference_resolution(spark, sf_dir):
    refs = links(spark, sf_dir).select("page_id", F.concat(F.lit("/in/"), F.lower(F.expr("substring(target, 2)"))).alias("target"))
    known = refs.where("page_id % 3 = 0").select(F.col("target").alias("id")).distinct().withColumn("is_document", F.lit(False))
    aliases = refs.where("page_id % 3 = 1").select(F.col("target").alias("alias"), F.concat("target", F.lit("-act")).alias("id")).distinct()
    return graph.resolve(refs, "target", known, aliases, F.col("target")).select("page_id", "target", "status")


@query("unresolved_report", f"""WITH x AS ({LINKS}) SELECT target, 'document_missing' AS status, count(*) AS occurrences, count(DISTINCT page_id) AS n_sources FROM x WHERE target NOT IN (SELECT target FROM x WHERE page_id % 3 = 0) GROUP BY target""")
def unresolved_report(spark, sf_dir):
    refs = links(spark, sf_dir)
    known = refs.where("page_id % 3 = 0").select(F.col("target").alias("_t")).distinct()
    made = refs.join(known, F.col("target") == F.col("_t"), "left").withColumn("status", F.when(F.col("_t").isNotNull(), "resolved").otherwise("document_missing"))
    return graph.unresolved(made, "target", "status", "page_id").select("target", "status", "occurrences", "n_sources")


@query("unambiguous_aliases", "SELECT lower(p_name) AS alias, min(p_partkey) AS id FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) = 1")
def unambiguous_aliases(spark, sf_dir):
    return graph.unambiguous(table(spark, sf_dir, "part"), "p_name", "p_partkey")


@query("ambiguous_aliases", "SELECT lower(p_name) AS alias, count(DISTINCT p_partkey) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def ambiguous_aliases(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.lower("p_name").alias("alias")).agg(F.countDistinct("p_partkey").alias("n")).where("n > 1")


L2 = "list_sum(list_transform(list_zip(v, q), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))"


def knn_sql(where: str, k: int, bonus: str = "0.0") -> str:
    return f"""WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0), d AS (SELECT vec_id, {L2} AS distance, label FROM (SELECT vec_id, embedding AS v, q, label FROM embeddings, q WHERE {where}))
 SELECT vec_id, round(1 / (1 + distance) + {bonus}, 6) AS score FROM d ORDER BY 1 / (1 + distance) + {bonus} DESC, vec_id LIMIT {k}"""


def first_vector(spark, sf_dir):
    return list(table(spark, sf_dir, "embeddings").where("vec_id = 0").select("embedding").first()[0])


@query("knn_topk", knn_sql("vec_id <> 0", 10))
def knn_topk(spark, sf_dir):
    return vector.knn(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", first_vector(spark, sf_dir), 10, F.col("vec_id") != 0).select("vec_id", F.round("score", 6).alias("score"))


@query("knn_filtered", knn_sql("label = 1", 10))
def knn_filtered(spark, sf_dir):
    return vector.knn(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", first_vector(spark, sf_dir), 10, F.col("label") == 1).select("vec_id", F.round("score", 6).alias("score"))


@query("hybrid_rerank", knn_sql("vec_id <> 0", 10, "(CASE WHEN label = 5 THEN 0.05 ELSE 0 END)"))
def hybrid_rerank(spark, sf_dir):
    bonus = F.when(F.col("label") == 5, 0.05).otherwise(0.0)
    return vector.knn(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", first_vector(spark, sf_dir), 10, F.col("vec_id") != 0, bonus).select("vec_id", F.round("score", 6).alias("score"))


@query("knn_join", f"""WITH p AS (SELECT b.vec_id AS query_id, a.vec_id, {L2.replace('v, q', 'a.embedding, b.embedding')} AS distance FROM embeddings a JOIN embeddings b ON b.vec_id < 20 AND a.vec_id <> b.vec_id),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM p) SELECT query_id, rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 5""")
def knn_join(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return vector.knn_join(e, e.where("vec_id < 20"), "vec_id", "embedding", "vec_id", 5).select("query_id", "rank", "vec_id", F.round("distance", 6).alias("distance"))


@query("related_items", f"""WITH e AS ({EDGES}), u AS (SELECT target AS id, 'outgoing' AS via, 1.0 AS score, 0 AS p FROM e WHERE source = '/nation/3' UNION ALL SELECT source, 'incoming', 0.95, 1 FROM e WHERE target = '/nation/3')
 SELECT id, via, score::DOUBLE AS score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p, score DESC) AS n FROM u) WHERE n = 1 ORDER BY score DESC, id LIMIT 10""")
def related_items(spark, sf_dir):
    e = edges(spark, sf_dir)
    out = e.where("source = '/nation/3'").select(F.col("target").alias("id"), F.lit("outgoing").alias("via"), F.lit(1).alias("rank"))
    into = e.where("target = '/nation/3'").select(F.col("source").alias("id"), F.lit("incoming").alias("via"), F.lit(1).alias("rank"))
    return graph.related([(1.0, out), (0.95, into)], 10)
