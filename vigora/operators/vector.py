"""Exact vector search: a bounded set of query vectors against a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors that may be sent to every task.
MAX_QUERIES = 1_000


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda t, x: t + x)


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)


def knn(base: DataFrame, key: str, vector: str, query: list[float], k: int, where: Column | None = None, bonus: Column | None = None) -> DataFrame:
    """The k nearest rows by squared distance, filtered before they are ranked; score 1 / (1 + distance) and a bonus. Each task keeps k rows."""
    rows = base.where(where) if where is not None else base
    q = F.array(*[F.lit(float(x)) for x in query])
    made = rows.withColumn("distance", squared_distance(F.col(vector), q))
    made = made.withColumn("score", 1 / (1 + F.col("distance")) + (bonus if bonus is not None else F.lit(0.0)))
    return made.orderBy(F.desc("score"), key).limit(k)


def knn_join(base: DataFrame, queries: DataFrame, key: str, vector: str, query_key: str, k: int) -> DataFrame:
    """query id, rank, key, distance for at most ``MAX_QUERIES`` queries, whose number is checked before they are broadcast.

    Each map task keeps its own k best of every query before anything moves;
    llm.neighbours is the way for more queries than that.
    """
    n = queries.limit(MAX_QUERIES + 1).count()
    if n > MAX_QUERIES:
        raise ValueError(f"more than {MAX_QUERIES} queries")
    q = queries.select(F.col(query_key).alias("query_id"), F.col(vector).alias("_q"))
    gathered = q.agg(F.collect_list(F.struct("query_id", "_q")).alias("qs"))
    pairs = base.select(key, vector).join(F.broadcast(gathered)).select(key, vector, F.explode("qs").alias("q"))
    scored = pairs.select(F.col("q.query_id").alias("query_id"), key, squared_distance(F.col(vector), F.col("q._q")).alias("distance")).where(F.col(key) != F.col("query_id"))
    w = Window.partitionBy("query_id").orderBy("distance", key)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
