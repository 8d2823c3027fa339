"""Ledgers of amendment events: merging, conflicts, routing, overlays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigora.functions.text import replace_pairs

#: How good an event's status is.
STATUS_RANK = {"materialized": 3, "validated": 2, "candidate": 1, "needs_review": 0, "rejected": -1}


def status_rank(status: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv])
    return F.coalesce(F.try_element_at(ranks, status), F.lit(0))


def quality(status: Column, materializable: Column, review: Column, canonical: Column) -> Column:
    """Ordered quality of an event."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return F.struct(status_rank(status).alias("s"), flag(materializable).alias("m"), (1 - flag(review)).alias("r"), flag(canonical).alias("c"))


def merge(ledgers: list[DataFrame], key: str, rank: Column) -> DataFrame:
    """One row a key: the strictly best of all ledgers, the earlier ledger in a tie; rows without a key go. Added: src_ord."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [d.withColumn("src_ord", F.lit(k)) for k, d in enumerate(ledgers)]).where(F.col(key).isNotNull())
    # One aggregate with map-side combine; a window would move and sort every row.
    return rows.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*rows.columns), F.struct(rank.alias("q"), (-F.col("src_ord")).alias("o"))).alias("_row")).select("_row.*")


def conflicts(events: DataFrame, component: str, date: str, payload: str, document: str, clean: Column, materializable: Column) -> DataFrame:
    """Events that share a component and date but not their payload or source. Added: conflict.

    A slot with exactly one clean row, all others not materialisable, is none.
    """
    hashed = events.withColumn("_hash", F.sha2(F.col(payload).cast("string"), 256))
    slots = hashed.groupBy(component, date).agg(
        F.count("*").alias("_n"), F.countDistinct("_hash").alias("_hashes"), F.countDistinct(document).alias("_docs"),
        F.sum(clean.cast("int")).alias("_clean"), F.sum((~clean & materializable).cast("int")).alias("_other"),
    )
    bad = (F.col("_n") >= 2) & ~((F.col("_clean") == 1) & (F.col("_other") == 0)) & ((F.col("_hashes") > 1) | (F.col("_docs") > 1))
    slots = slots.where(bad).select(F.col(component).alias("_c"), F.col(date).alias("_d"))
    hit = hashed.join(slots, (F.col(component) == F.col("_c")) & (F.col(date) == F.col("_d")), "left")
    return hit.withColumn("conflict", F.col("_c").isNotNull()).drop("_c", "_d", "_hash")


def route(events: DataFrame, lanes: list[tuple[str, Column]], otherwise: str = "ready") -> DataFrame:
    """Each event's first lane whose test holds; the order of the lanes is part of their meaning. Added: lane."""
    lane = reduce(lambda made, x: made.when(x[1], x[0]), lanes[1:], F.when(lanes[0][1], lanes[0][0])).otherwise(otherwise)
    return events.withColumn("lane", lane)


def reasons(tests: list[tuple[str, Column]]) -> Column:
    """Names of the tests that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests]))


def breakdown(rows: DataFrame, reason: str, extra: str) -> DataFrame:
    """Counts by what stands before the colon of a reason, and by each of an array of reasons."""
    first = rows.groupBy(F.substring_index(reason, ":", 1).alias("value")).agg(F.count("*").alias("n")).select(F.lit("skip_reason").alias("kind"), "value", "n")
    second = rows.select(F.explode(extra).alias("value")).groupBy("value").agg(F.count("*").alias("n")).select(F.lit("review_reason").alias("kind"), "value", "n")
    return first.unionByName(second)


def apply_decisions(events: DataFrame, decisions: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Values a decision gives replace the event's own; others stay. Decisions: one row a key. Added: decided."""
    given = decisions.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    made = events.join(given, F.col(key) == F.col("_k"), "left").withColumn("decided", F.col("_k").isNotNull())
    return made.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in columns}).drop("_k", *[f"_{c}" for c in columns])


def apply_corrigenda(events: DataFrame, corrigenda: DataFrame, ref: str, text: str) -> DataFrame:
    """Ordered corrections (ref, seq, old, new) of each notification, each to the first occurrence. Added: corrected, before_sha256, after_sha256."""
    pairs = corrigenda.groupBy(F.col(ref).alias("_ref")).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "old", "new"))), lambda p: F.struct(p.old.alias("old"), p.new.alias("new"))).alias("_pairs"))
    made = events.join(pairs, F.col(ref) == F.col("_ref"), "left").withColumn("_new", F.when(F.col("_pairs").isNotNull(), replace_pairs(F.col(text), F.col("_pairs"))).otherwise(F.col(text)))
    return made.withColumns({"before_sha256": F.sha2(text, 256), "after_sha256": F.sha2("_new", 256), "corrected": ~F.col(text).eqNullSafe(F.col("_new")), text: F.col("_new")}).drop("_ref", "_pairs", "_new")


def rescinded(events: DataFrame, document: str, refs: DataFrame) -> DataFrame:
    """Flags events of documents that ``refs`` (document) rescinds. Added: rescinded."""
    gone = refs.select(F.col(document).alias("_d")).where("_d IS NOT NULL").distinct()
    return events.join(gone, F.col(document) == F.col("_d"), "left").withColumn("rescinded", F.col("_d").isNotNull()).drop("_d")


def covering(events: DataFrame, applied: DataFrame, keys: list[str], start: str, end: str, event: str, least: float = 0.8) -> DataFrame:
    """For each event the first applied one with the same keys whose span covers ``least`` of the shorter of the two. Equi-join first, spans after."""
    other = applied.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(event).alias("covering_event"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    both = F.greatest(F.lit(0), F.least(F.col(end), F.col("_e")) - F.greatest(F.col(start), F.col("_s")))
    short = F.least(F.col(end) - F.col(start), F.col("_e") - F.col("_s"))
    hits = events.join(other, on & (F.col(event) != F.col("covering_event"))).where((short > 0) & (both >= least * short))
    first = hits.groupBy(F.col(event).alias("_id")).agg(F.min("covering_event").alias("covering_event"))
    return events.join(first, F.col(event) == F.col("_id"), "left").drop("_id")


def linkage(events: DataFrame, ref: str, event: str, target: str, kind: Column) -> DataFrame:
    """What each notification touches: its events and its targets by kind."""
    kinds = ("act_section", "rule", "form")
    return events.groupBy(ref).agg(
        F.array_sort(F.collect_set(event)).alias("events"),
        *[F.array_sort(F.collect_set(F.when(kind == k, F.col(target)))).alias(f"{k}s") for k in kinds],
    )


def commencement(rows: DataFrame, keys: list[str], date: str, seq: str, excepted: DataFrame | None = None) -> DataFrame:
    """The date each section comes into force: the last notification wins, excepted sections have none."""
    made = rows.groupBy(*keys).agg(F.max_by(date, seq).alias(date))
    return made.join(excepted.select(*keys), keys, "left_anti") if excepted is not None else made


def expand_ranges(rows: DataFrame, low: str, high: str, name: str) -> DataFrame:
    """A row for each number of a range such as sections 92 to 96."""
    return rows.withColumn(name, F.explode(F.sequence(F.col(low), F.coalesce(F.col(high), F.col(low)))))


def superseded(events: DataFrame, document: str, refers: str, date: str) -> DataFrame:
    """(superseded, superseding): the earliest later notification that says so."""
    later = events.select(F.col(refers).alias("superseded"), F.col(document).alias("superseding"), F.col(date).alias("_d")).where("superseded IS NOT NULL")
    own = events.select(F.col(document).alias("superseded"), F.col(date).alias("_own")).distinct()
    return later.join(own, "superseded").where(F.col("_d") >= F.col("_own")).groupBy("superseded").agg(F.min_by("superseding", F.struct("_d", "superseding")).alias("superseding"))


def first_seen(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Repeats of a key stay but are marked. Added: repeat."""
    return rows.withColumn("repeat", F.row_number().over(Window.partitionBy(key).orderBy(*order)) > 1)
