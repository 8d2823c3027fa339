"""Validity intervals: half-open [from, to), an open end is null; of several that cover a date, the latest start wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(events: DataFrame, key: str, at: str, *order: str) -> DataFrame:
    """Each event opens a version that the key's next event closes. Added: seq, valid_from, valid_to, chain_length.

    One shuffle on the key serves all window functions.
    """
    w = Window.partitionBy(key).orderBy(at, *order)
    return events.withColumns({"seq": F.row_number().over(w), "valid_from": F.col(at), "valid_to": F.lead(at).over(w), "chain_length": F.count("*").over(w.rowsBetween(Window.unboundedPreceding, 0))})


def chains(events: DataFrame, key: str, event: str, at: str, *order: str) -> DataFrame:
    """Each version's whole chain of events. Its size grows with the square of a key's events; ask for chain_length instead where that is enough."""
    w = Window.partitionBy(key).orderBy(at, *order).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn("event_chain", F.collect_list(event).over(w))


def covers(start: Column | str, end: Column | str, date: Column) -> Column:
    s, e = (F.col(x) if isinstance(x, str) else x for x in (start, end))
    return (s <= date) & (e.isNull() | (date < e))


def as_of(versions: DataFrame, key: str, date: Column, start: str = "valid_from", end: str = "valid_to", tie: str | None = None) -> DataFrame:
    """The version of each key that is in force; keys without one have no row.

    For versions that are stored with their ends: the filter reaches the scan,
    the rest is one map-side combined aggregate. From bare events, see in_force.
    """
    row = F.struct(*versions.columns)
    order = F.struct(start, tie) if tie else F.col(start)
    return versions.where(covers(start, end, date)).groupBy(F.col(key).alias("_key")).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def in_force(events: DataFrame, key: str, at: str, date: Column, *order: str) -> DataFrame:
    """The version of each key that is in force, from the events that open versions; added: seq, valid_from, valid_to.

    The same rows as ``as_of`` on ``intervals``, without ordering any key's
    history: the last event up to the date, how many there are, and when the
    first later one is, all in one map-side combined aggregate.
    """
    now = F.col(at) <= date
    last = F.max_by(F.when(now, F.struct(*events.columns)), F.when(now, F.struct(at, *order)))
    made = events.groupBy(F.col(key).alias("_key")).agg(last.alias("_row"), F.count(F.when(now, 1)).alias("seq"), F.min(F.when(F.col(at) > date, F.col(at))).alias("valid_to"))
    return made.where("seq > 0").select("_row.*", "seq", F.col(f"_row.{at}").alias("valid_from"), "valid_to")


def last_known(versions: DataFrame, key: str, date: Column, start: str = "valid_from", tie: str | None = None) -> DataFrame:
    """The latest version that began on or before the date, whether or not it has ended."""
    order = F.struct(start, tie) if tie else F.col(start)
    return versions.where(F.col(start) <= date).groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*versions.columns), order).alias("_row")).select("_row.*")


def first_after(versions: DataFrame, key: str, date: Column, start: str = "valid_from", tie: str | None = None) -> DataFrame:
    order = F.struct(start, tie) if tie else F.col(start)
    return versions.where(F.col(start) > date).groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*versions.columns), order).alias("_row")).select("_row.*")


def as_of_or_last(versions: DataFrame, key: str, date: Column, start: str = "valid_from", end: str = "valid_to", tie: str | None = None) -> DataFrame:
    """The version in force, else the key's last row: every key has a row. Added: in_force."""
    order = F.struct(F.when(covers(start, end, date), 1).otherwise(0).alias("c"), F.col(start), *([F.col(tie)] if tie else []))
    made = versions.withColumn("in_force", covers(start, end, date))
    return made.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*made.columns), order).alias("_row")).select("_row.*")


def as_of_join(probes: DataFrame, key: str, at: str, probe_id: str, versions: DataFrame, version_key: str, start: str, *values: str) -> DataFrame:
    """For each probe the latest version of its key that began on or before it; null values where there is none.

    Both sides are put in one ordered stream per key and the last version is
    carried forward, so a key's rows are sorted once and never paired: no range
    join, whose output grows with probes times versions.
    """
    value = F.struct(F.col(start).alias("version_start"), *[F.col(v) for v in values])
    left = probes.select(F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(1).alias("_side"), F.col(probe_id).alias("_id"), F.lit(None).cast(versions.select(value.alias("v")).schema["v"].dataType).alias("_v"))
    right = versions.select(F.col(version_key).alias("_k"), F.col(start).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(probes.schema[probe_id].dataType).alias("_id"), value.alias("_v"))
    w = Window.partitionBy("_k").orderBy("_t", "_side", *[F.col(f"_v.{v}") for v in values]).rowsBetween(Window.unboundedPreceding, 0)
    carried = left.unionByName(right).withColumn("_last", F.last("_v", ignorenulls=True).over(w))
    return carried.where("_side = 1").select(F.col("_id").alias(probe_id), F.col("_k").alias(key), F.col("_t").alias(at), "_last.*")


def between(versions: DataFrame, low: Column, high: Column, start: str = "valid_from") -> DataFrame:
    """Events after the earlier date and up to the later one, whichever way round they are given."""
    return versions.where((F.col(start) > F.least(low, high)) & (F.col(start) <= F.greatest(low, high)))


def compare(versions: DataFrame, key: str, low: Column, high: Column, value: str, base: Column | None = None, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Two states of each key: from_*, to_*, changed, n_events between, status (ok or partial_history)."""
    rank = lambda d: F.struct(F.col(start), F.col(value))
    pick = lambda d, name: F.max_by(F.when(covers(start, end, d), F.col(value)), F.when(covers(start, end, d), rank(d))).alias(name)
    found = lambda d, name: F.max(covers(start, end, d).cast("int")).alias(name)
    lo, hi = F.least(low, high), F.greatest(low, high)
    made = versions.groupBy(key).agg(
        pick(low, "from_value"), pick(high, "to_value"), found(low, "has_from"), found(high, "has_to"),
        F.sum(((F.col(start) > lo) & (F.col(start) <= hi)).cast("int")).alias("n_events"),
    )
    early = F.lit(False) if base is None else (low < base) | (high < base)
    partial = early | (F.col("has_from") == 0) | (F.col("has_to") == 0)
    return made.select(
        key, "from_value", "to_value", (~F.coalesce(F.col("from_value").cast("string"), F.lit("")).eqNullSafe(F.coalesce(F.col("to_value").cast("string"), F.lit("")))).alias("changed"),
        "n_events", F.when(partial, "partial_history").otherwise("ok").alias("status"),
    )


def overlaps(versions: DataFrame, key: str, identity: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions that begin before the running latest end of their key's earlier versions. A sort and a running maximum, no self-join."""
    w = Window.partitionBy(key).orderBy(start, identity).rowsBetween(Window.unboundedPreceding, -1)
    open_end = F.max(F.col(end).isNull().cast("int")).over(w)
    return versions.withColumns({"_latest": F.max(end).over(w), "_open": open_end}).where((F.col("_open") == 1) | (F.col(start) < F.col("_latest"))).drop("_latest", "_open")


def change_points(rows: DataFrame, key: str, at: str, state: Column, *order: str) -> DataFrame:
    """Rows whose state differs from the key's state before (null-safe); the first row counts. Added: previous."""
    w = Window.partitionBy(key).orderBy(at, *order)
    made = rows.withColumns({"_state": state, "previous": F.lag(state).over(w), "_n": F.row_number().over(w)})
    return made.where((F.col("_n") == 1) | ~F.col("_state").eqNullSafe(F.col("previous"))).drop("_state", "_n")


def shrink_guard(versions: DataFrame, key: str, text: str, operation: str, *order: str, share: float = 0.3, least: int = 500, exempt: tuple[str, ...] = ("OMIT", "INSERT_SIBLING")) -> DataFrame:
    """A text under ``share`` of the longest earlier one (if that has ``least`` characters) gives way to it. Added: guarded, text_sha256 (of the text that stays)."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    longest = F.max_by(F.col(text), F.length(text)).over(w)
    made = versions.withColumn("_longest", longest)
    hit = (F.length("_longest") >= least) & (F.length(text) < share * F.length("_longest")) & ~F.col(operation).isin(*exempt)
    made = made.withColumn("guarded", F.coalesce(hit, F.lit(False)))
    return made.withColumn(text, F.when(F.col("guarded"), F.col("_longest")).otherwise(F.col(text))).withColumn("text_sha256", F.sha2(text, 256)).drop("_longest")


def inherited(rows: DataFrame, key: str, value: str, *order: str) -> Column:
    """The last value given before or in a row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def islands(rows: DataFrame, key: str, starts: Column, *order: str) -> DataFrame:
    """Runs of rows that begin where ``starts`` holds. Added: island."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("island", F.sum(starts.cast("int")).over(w))
