"""Reference graphs as node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigora.functions.ids import resolution


def nodes(parts: list[DataFrame]) -> DataFrame:
    """Nodes given under several kinds are one: id, kinds (sorted), kind (joined by +), label. parts: id, kind, label."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    made = rows.groupBy("id").agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.min("label").alias("label"))
    return made.select("id", "kinds", F.array_join("kinds", "+").alias("kind"), "label")


def edges(rows: DataFrame, *key: str) -> DataFrame:
    return rows.dropDuplicates(list(key) or ["source", "target", "type"])


def neighbours(edge: DataFrame, node: Column, side: str, k: int = 50) -> DataFrame:
    """Edges from (side 'source') or to (side 'target') a node, ordered."""
    return edge.where(F.col(side) == node).orderBy("source", "target", "type").limit(k)


def paths(edge: DataFrame, start: Column, depth: int, hit: Column | None = None) -> DataFrame:
    """Breadth-first paths from the start: depth, node, path, one for each edge that reaches a node at a depth; a hit does not end its path.

    Only the least path to a node goes on from it at each depth: each step is an
    equi-join of the frontier with the edges and one aggregate, so the frontier
    never holds more than a row a node.
    """
    keep = lambda rows: rows.groupBy("depth", "node").agg(F.min("path").alias("path"))
    now = edge.where(F.col("source") == start).select(F.lit(1).alias("depth"), F.col("target").alias("node"), F.array("source", "target").alias("path"))
    found, now = now, keep(now)
    for d in range(2, depth + 1):
        step = now.select("node", "path").join(edge.select("source", "target"), F.col("node") == F.col("source"))
        now = step.select(F.lit(d).alias("depth"), F.col("target").alias("node"), F.concat("path", F.array("target")).alias("path"))
        found, now = found.unionByName(now), keep(now)
    return found.where(hit) if hit is not None else found


def resolve(refs: DataFrame, target: str, known: DataFrame, aliases: DataFrame, document: Column) -> DataFrame:
    """Adds status and resolved to references. known: id, is_document; aliases: alias, id (unambiguous ones only)."""
    ids = known.select(F.col("id").alias("_id")).distinct()
    docs = known.where("is_document").select(F.col("id").alias("_doc")).distinct()
    made = refs.withColumn("_document", document).join(ids, F.col(target) == F.col("_id"), "left").join(docs, F.col("_document") == F.col("_doc"), "left")
    made = made.join(aliases.select(F.col("alias").alias("_alias"), F.col("id").alias("_to")), F.col("_document") == F.col("_alias"), "left")
    moved = F.concat("_to", F.substring(F.col(target), F.length("_document") + 1, F.length(target)))
    made = made.withColumn("_moved", moved).join(known.select(F.col("id").alias("_known2")).distinct(), F.col("_moved") == F.col("_known2"), "left")
    status = resolution(F.col(target), F.col("_id").isNotNull(), F.col("_to").isNotNull(), F.col("_known2").isNotNull(), F.col("_doc").isNotNull())
    return made.withColumn("status", status).withColumn("resolved", F.when(F.col("status") == "resolved", F.col(target)).when(F.col("status") == "resolved_by_alias", F.col("_moved"))).drop("_document", "_id", "_doc", "_alias", "_to", "_moved", "_known2")


def unambiguous(rows: DataFrame, alias: str, key: str) -> DataFrame:
    """alias, id where one id alone has the alias; case and blanks folded."""
    folded = rows.select(F.lower(F.regexp_replace(F.trim(alias), r"\s+", " ")).alias("alias"), F.col(key).alias("id"))
    return folded.groupBy("alias").agg(F.min("id").alias("id"), F.countDistinct("id").alias("n")).where("n = 1").drop("n")


def unresolved(refs: DataFrame, target: str, status: str, source: str, samples: int = 5) -> DataFrame:
    """target, status, occurrences, n_sources, sources: references that lead nowhere, most frequent first."""
    return (
        refs.where(~F.col(status).isin("resolved", "resolved_by_alias")).groupBy(target, status)
        .agg(F.count("*").alias("occurrences"), F.countDistinct(source).alias("n_sources"), F.slice(F.array_sort(F.collect_set(source)), 1, samples).alias("sources"))
        .orderBy(F.desc("occurrences"), target)
    )


def statements(edge: DataFrame, relationship: Column) -> DataFrame:
    """Parameterised merge statements for a property-graph store, by relationship type: type, statement, rows."""
    made = edge.withColumn("rel", relationship)
    text = F.concat(F.lit("UNWIND $rows AS row MATCH (a {id: row.source}) MATCH (b {id: row.target}) MERGE (a)-[:"), F.col("rel"), F.lit("]->(b)"))
    return made.groupBy("rel").agg(F.count("*").alias("n")).select(F.col("rel").alias("type"), text.alias("statement"), "n")


def related(parts: list[tuple[float, DataFrame]], k: int) -> DataFrame:
    """id, score, via: neighbours of several kinds, each id once by its first kind. parts: (score, id + via + rank) in order of priority."""
    rows = None
    for priority, (score, part) in enumerate(parts):
        made = part.select("id", "via", (F.lit(score) / F.greatest(F.col("rank"), F.lit(1))).alias("score"), F.lit(priority).alias("priority"))
        rows = made if rows is None else rows.unionByName(made)
    best = rows.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("priority", F.desc("score")))).where("_n = 1")
    return best.select("id", "via", "score").orderBy(F.desc("score"), "id").limit(k)


def forms_of(edge: DataFrame, rule: Column, prefix: str, contains: str = "CONTAINS", k: int = 50) -> DataFrame:
    """Edges from a rule, or from a part that it contains, to targets that begin with ``prefix``: one for each target, the least of them."""
    out = edge.where(F.col("source") == rule)
    parts = out.where((F.col("type") == contains) & F.startswith(F.col("target"), F.concat(rule, F.lit("/")))).select(F.col("target").alias("_part"))
    held = edge.join(parts.distinct(), F.col("source") == F.col("_part"), "left_semi").unionByName(out)
    found = held.where(F.startswith(F.col("target"), F.lit(prefix)))
    return found.groupBy("target").agg(F.min(F.struct("source", "type")).alias("e")).select("e.source", "target", "e.type").orderBy("target").limit(k)


def with_nodes(edge: DataFrame, node: DataFrame, *fields: str) -> DataFrame:
    """Edges with the fields of both their nodes, as source_<field> and target_<field>; null where a node is not known."""
    for side in ("source", "target"):
        names = node.select(F.col("id").alias(f"_{side}"), *[F.col(f).alias(f"{side}_{f}") for f in fields])
        edge = edge.join(names, F.col(side) == F.col(f"_{side}"), "left").drop(f"_{side}")
    return edge


def by_alias(values: DataFrame, value: str, works: DataFrame, aliases: DataFrame) -> DataFrame:
    """``values`` with resolved: the work of that id, else the one with that alias (case and white space aside). works: work_id; aliases: alias, work_id; an alias of several works resolves to none."""
    folded = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    single = aliases.groupBy(folded(F.col("alias")).alias("_alias")).agg(F.min("work_id").alias("_by_alias"), F.countDistinct("work_id").alias("_n")).where("_n = 1").drop("_n")
    known = works.select(F.col("work_id").alias("_work")).distinct()
    made = values.join(known, F.col(value) == F.col("_work"), "left").join(single, folded(F.col(value)) == F.col("_alias"), "left")
    return made.withColumn("resolved", F.coalesce("_work", "_by_alias")).drop("_work", "_alias", "_by_alias")

