"""Structured Streaming forms: windows, late rows, resumable de-duplication, stateful versions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, at: str, width: str, *keys: str, late: str | None = None) -> DataFrame:
    """Counts and sums by fixed windows; the same plan for a table and, with a watermark, for a stream."""
    rows = events.withWatermark(at, late) if late else events
    return rows.groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), *keys, "n", "total")


def sliding(events: DataFrame, at: str, width: str, slide: str, *keys: str, late: str | None = None) -> DataFrame:
    rows = events.withWatermark(at, late) if late else events
    return rows.groupBy(F.window(at, width, slide), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")


def sessions(events: DataFrame, at: str, gap: str, key: str, late: str | None = None) -> DataFrame:
    rows = events.withWatermark(at, late) if late else events
    return rows.groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def once(events: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Each key once while the watermark has not passed it: a resumable append."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def late_split(events: DataFrame, effective: str, observed: str) -> tuple[DataFrame, DataFrame]:
    """(in time, retrospective): rows that take effect before they were seen rewrite history and go to a rebuild."""
    retrospective = F.col(effective) < F.col(observed)
    return events.where(~F.coalesce(retrospective, F.lit(False))), events.where(retrospective)


STATE = "last_at timestamp, n long"
OUT = "key string, seq long, valid_from timestamp, previous_from timestamp"


def versions(events: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Opens a version for each event of a key as it arrives: seq, valid_from and the version it closes. State is one row a key."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(k, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (None, 0)
        rows = []
        for t in pd.concat(list(batches))["at"].sort_values():
            n += 1
            rows.append((k[0], n, t, last))
            last = t
        state.update((last, n))
        yield pd.DataFrame(rows, columns=["key", "seq", "valid_from", "previous_from"])

    rows = events.select(F.col(key).cast("string").alias("key"), F.col(at).alias("at")).withWatermark("at", late)
    return rows.groupBy("key").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
