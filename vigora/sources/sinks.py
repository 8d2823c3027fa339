"""Writers. All of them write in parallel; nothing is gathered first."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def parquet(df: DataFrame, path: str, *partitions: str, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def jsonl(df: DataFrame, path: str, *order: str, mode: str = "overwrite") -> None:
    """Sorted-key JSON, one object a line; with an order, sorted by it over all files."""
    rows = df.select(*sorted(df.columns))
    (rows.orderBy(*order) if order else rows).write.mode(mode).json(path)


def snapshots(versions: DataFrame, path: str, date: str) -> None:
    """A folder for each effective date."""
    versions.repartition(date).write.mode("overwrite").partitionBy(date).parquet(path)


def flat_yaml(df: DataFrame, path: str, key: str = "key", value: str = "value") -> None:
    df.select(F.concat_ws(": ", key, value).alias("value")).write.mode("overwrite").text(path)


def bucketed(df: DataFrame, name: str, buckets: int, *keys: str) -> None:
    """A table whose joins and windows on the keys need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def batches(df: DataFrame, send: Callable[[list[Row]], None], size: int = 500) -> None:
    """Sends rows to an outside store in batches, from the tasks that hold them."""

    def run(rows: Iterable[Row]) -> None:
        held: list[Row] = []
        for row in rows:
            held.append(row)
            if len(held) >= size:
                send(held)
                held = []
        if held:
            send(held)

    df.foreachPartition(run)


def api_payload(documents: DataFrame, provisions: DataFrame) -> dict[str, DataFrame]:
    """documents, provisions, references (both roles'), stats."""
    refs = documents.select("canonical_id", F.explode("refs").alias("r")).unionByName(provisions.select("canonical_id", F.explode("refs").alias("r"))).select(F.col("canonical_id").alias("source"), "r.*").distinct()
    stats = documents.agg(F.count("*").alias("documents")).crossJoin(F.broadcast(provisions.agg(F.count("*").alias("provisions")))).crossJoin(F.broadcast(refs.agg(F.count("*").alias("references"))))
    return {"documents": documents, "provisions": provisions, "references": refs, "stats": stats}
