"""The review chain: slots, groups, candidates, evidence, dependencies and set-level validation, each as one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Outcomes that leave a component open, operations that edit text in place, states of a finished review.
OPEN_OUTCOMES = ("true_substantive_mismatch", "missing_reconstruction", "checkpoint_source_incomplete")
TEXT_EDITS = ("SPLICE", "SUBSTITUTE", "OMIT", "INSERT_CHILD")
REVIEWED = ("accepted", "validated", "rejected")


def open_reconciliations(outcomes: DataFrame, components: DataFrame, start: Column, end: Column) -> DataFrame:
    """Components with the outcomes of checkpoints between two dates (in either order; an undated checkpoint counts) that leave them open."""
    low, high = F.least(start, end), F.greatest(start, end)
    inside = F.col("checkpoint_date").isNull() | F.col("checkpoint_date").between(low, high)
    return outcomes.where(inside & F.col("status").isin(*OPEN_OUTCOMES)).join(components.select("component_id").distinct(), "component_id", "left_semi")


def with_confidence(rows: DataFrame, tiers: DataFrame) -> DataFrame:
    """Rows with their component's tier and reasons; 'unknown' and none where there is no tier. tiers: component_id, tier, reasons (one row a component)."""
    return rows.join(tiers, "component_id", "left").withColumn("tier", F.coalesce("tier", F.lit("unknown"))).withColumn("reasons", F.coalesce("reasons", F.array().cast("array<string>")))


def cited_chains(chains: DataFrame, events: DataFrame, sources: DataFrame) -> DataFrame:
    """For each component: whether every event of its chain is known and cites a known source, and which do not.

    chains: component_id, event_chain. events: event_id, document_id. sources: document_id.
    """
    links = chains.select("component_id", F.explode_outer("event_chain").alias("event_id"))
    known = sources.select(F.col("document_id")).distinct().withColumn("_known", F.lit(True))
    made = links.join(events.select("event_id", "document_id"), "event_id", "left").join(known, "document_id", "left")
    missing = F.col("event_id").isNotNull() & F.col("_known").isNull()
    return made.groupBy("component_id").agg(
        F.count("event_id").alias("n_events"), F.array_sort(F.collect_list(F.when(missing, F.col("event_id")))).alias("uncited"),
    ).withColumn("cited", (F.col("n_events") > 0) & (F.size("uncited") == 0))


def by_related(rows: DataFrame, ids: str, row: str) -> DataFrame:
    """An index: each related id with the rows that name it."""
    return rows.select(F.explode(ids).alias("related"), F.col(row).alias("_row")).groupBy("related").agg(F.array_sort(F.collect_set("_row")).alias("rows"))


def dependencies(gaps: DataFrame, insertions: DataFrame, decided: DataFrame) -> DataFrame:
    """Missing anchors with the insertions that would make them: approved if there is just one that is not decided yet, else why not.

    gaps: event_id, missing_component_id. insertions: event_id, component_id. decided: event_id.
    """
    wanted = gaps.groupBy("missing_component_id").agg(F.count("*").alias("n_gaps"))
    free = insertions.join(decided.select("event_id").distinct(), "event_id", "left_anti").groupBy(F.col("component_id").alias("missing_component_id")).agg(F.count("*").alias("_n"), F.min("event_id").alias("_first"))
    made = wanted.join(free, "missing_component_id", "left")
    n = F.coalesce("_n", F.lit(0))
    return made.select("missing_component_id", "n_gaps", F.when(n == 1, "approved").when(n == 0, "no_candidate_found").otherwise("ambiguous_candidates").alias("outcome"), F.when(n == 1, F.col("_first")).alias("event_id"))


def replaced(rows: DataFrame, better: DataFrame, key: str, where: Column) -> DataFrame:
    """``rows`` in which those that hold ``where`` give way to the row of ``better`` with their key, if it has one; both have the same columns."""
    other = [c for c in rows.columns if c != key]
    found = better.select(F.col(key).alias("_key"), F.struct(*other).alias("_better"))
    made = rows.join(found, (F.col(key) == F.col("_key")) & where, "left")
    return made.select(key, *[F.when(F.col("_better").isNotNull(), F.col(f"_better.{c}")).otherwise(F.col(c)).alias(c) for c in other])


def archives(rows: DataFrame, sha: str, text: str, order: str) -> DataFrame:
    """Each hash with the text that came last."""
    return rows.where(F.col(sha).isNotNull()).groupBy(sha).agg(F.max_by(text, order).alias(text))


def inventory_errors(rows: DataFrame, key: str, stated: dict[str, int], group: str, required: list[str]) -> DataFrame:
    """Findings: check, value, n - repeated ids, groups whose rows are not as many as stated, and required fields that are not given."""
    repeated = rows.groupBy(F.col(key).cast("string").alias("value")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_id").alias("check"), "value", "n")
    counts = rows.sparkSession.createDataFrame(list(stated.items()), "value string, stated long")
    found = rows.groupBy(F.col(group).cast("string").alias("value")).agg(F.count("*").alias("n"))
    wrong = counts.join(found, "value", "full_outer").withColumn("n", F.coalesce("n", F.lit(0))).where(F.coalesce("stated", F.lit(0)) != F.col("n")).select(F.lit("count_mismatch").alias("check"), "value", "n")
    blank = F.explode(F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", c) for c in required])))
    bare = rows.select(blank.alias("value")).groupBy("value").agg(F.count("*").alias("n")).select(F.lit("missing_field").alias("check"), "value", "n")
    return repeated.unionByName(wrong).unionByName(bare)


def slots_allowed(events: DataFrame, *slot: str) -> DataFrame:
    """Slots with several events that may stand side by side.

    ordered_edits: text edits of one document (its tax suffix aside) at distinct
    places, each with a hash. insert_then_omit: an insertion and, published
    later, the omission of the whole. events: slot, operation, document_id,
    start, text_hash, whole, published, order.
    """
    document = F.regexp_replace(F.coalesce("document_id", F.lit("")), "-(central|union|integrated)-tax$", "")
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    first = F.min_by(F.struct("operation", "published"), "order")
    last = F.max_by(F.struct("operation", "published", "whole"), "order")
    made = events.withColumn("_doc", document).groupBy(*slot).agg(
        F.count("*").alias("n"), F.count_distinct("_doc").alias("_docs"), F.min("_doc").alias("_doc"), F.bool_and(F.col("operation").isin(*TEXT_EDITS)).alias("_edits"),
        F.count_distinct(F.coalesce("start", F.lit(-1))).alias("_starts"), F.bool_and(given("text_hash")).alias("_hashed"), first.alias("_first"), last.alias("_last"),
    ).where("n > 1")
    later = (F.coalesce("_first.published", F.lit("")) != "") & (F.col("_first.published") < F.col("_last.published"))
    return made.select(
        *slot, "n", ((F.col("_docs") == 1) & (F.col("_doc") != "") & F.col("_edits") & (F.col("_starts") == F.col("n")) & F.col("_hashed")).alias("ordered_edits"),
        F.coalesce((F.col("n") == 2) & (F.col("_first.operation") == "INSERT_SIBLING") & (F.col("_last.operation") == "OMIT") & F.col("_last.whole") & later, F.lit(False)).alias("insert_then_omit"),
    )


def grouped(rows: DataFrame, key: str, item: str, reasons: str, order: str, *first: str) -> DataFrame:
    """Review items by group, the largest groups first: count, items in order, the union of their reasons, and the first item's fields."""
    made = rows.groupBy(key).agg(
        F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct(order, item))), lambda x: x[item]).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(reasons)))).alias("reasons"), F.min_by(F.struct(*first), order).alias("_first"),
    )
    return made.select(key, "n", "items", "reasons", "_first.*").orderBy(F.desc("n"), *first, key)


def most_gaps(gaps: DataFrame, key: str, lane: str, k: int = 10) -> DataFrame:
    """The k keys with the most gaps, ties by key: gaps in all and by lane."""
    lanes = gaps.where(F.col(key).isNotNull()).groupBy(key, lane).agg(F.count("*").alias("_n"))
    made = lanes.groupBy(key).agg(F.sum("_n").alias("n_gaps"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(lane, "_n")))).alias("lanes"))
    return made.orderBy(F.desc("n_gaps"), key).limit(k)


def sources_of_entries(events: DataFrame) -> DataFrame:
    """Each schedule and serial with the notifications that name it, in the order in which they first do.

    events: schedule, sno, sno_list, source, seq. A full stop after a serial and its case do not matter.
    """
    plain = lambda x: F.upper(F.regexp_replace(x, r"\.+$", ""))
    serials = F.array_distinct(F.concat(F.filter(F.array(plain(F.coalesce("sno", F.lit("")))), lambda x: x != ""), F.transform(F.coalesce("sno_list", F.array().cast("array<string>")), plain)))
    named = events.where(F.coalesce("source", F.lit("")) != "").select("schedule", F.explode(serials).alias("sno"), "source", "seq")
    first = named.groupBy("schedule", "sno", "source").agg(F.min("seq").alias("_seq"))
    return first.groupBy("schedule", "sno").agg(F.transform(F.array_sort(F.collect_list(F.struct("_seq", "source"))), lambda x: x.source).alias("sources"))


def filter_date(checkpoint: Column) -> Column:
    """The date that events are compared with: that of a service checkpoint without its prefix."""
    return F.regexp_replace(checkpoint, r"^svc_(\d{4}-\d{2}-\d{2})$", "$1")


def base_at(asked: DataFrame, bases: DataFrame, successions: DataFrame) -> DataFrame:
    """The base of a notification at a date: that which superseded it, if it did by then, else its own. asked: notification, date. bases: notification, base. successions: notification, successor, since."""
    later = successions.select(F.col("notification").alias("_from"), "successor", "since")
    made = asked.join(later, (F.col("notification") == F.col("_from")) & (F.col("date") >= F.col("since")), "left").withColumn("active", F.coalesce("successor", "notification"))
    own = bases.select(F.col("notification").alias("_active"), "base")
    return made.join(own, F.col("active") == F.col("_active"), "left").select(*asked.columns, "active", F.coalesce("base", F.lit("")).alias("base"))


def instrument_at(versions: DataFrame, key: str, document: str, start: str, date: Column) -> DataFrame:
    """The instrument behind each component at a date: that of the last version up to then that has a real document, else of the last one at all. Derived documents are not real."""
    real = versions.where((F.coalesce(F.col(document), F.lit("")) != "") & ~F.startswith(F.col(document), F.lit("derived/")))
    order = F.struct(F.when(F.col(start) <= date, 1).otherwise(0).alias("up_to"), F.col(start))
    return real.groupBy(key).agg(F.max_by(document, order).alias("instrument"))


def unreviewed(candidates: DataFrame, status: str) -> DataFrame:
    """Candidates that no review has ended; no status means proposed."""
    state = F.coalesce(F.col(status), F.lit("proposed"))
    return candidates.where(~state.isin(*REVIEWED)).withColumn(status, state)


def corpus_errors(documents: DataFrame, references: DataFrame, allow_missing: Column | None = None) -> DataFrame:
    """Findings of a corpus: check, value - ids found twice, files that are not where their id belongs, references to nothing.

    documents: id, path, expected_path. references: target.
    """
    repeated = documents.groupBy("id").agg(F.count("*").alias("_n")).where("_n > 1").select(F.lit("duplicate_id").alias("check"), F.col("id").alias("value"))
    misplaced = documents.where(F.col("path") != F.col("expected_path")).select(F.lit("path_mismatch").alias("check"), F.col("path").alias("value"))
    unknown = references.select(F.col("target").alias("value")).distinct().join(documents.select(F.col("id").alias("value")).distinct(), "value", "left_anti")
    unknown = unknown if allow_missing is None else unknown.where(~allow_missing)
    return repeated.unionByName(misplaced).unionByName(unknown.select(F.lit("unresolved_reference").alias("check"), "value"))


def manifest_errors(manifest: DataFrame, gaps: DataFrame) -> DataFrame:
    """Works whose manifest states another number of gaps than there are. manifest: work_id, n_gaps. gaps: work_id."""
    found = gaps.groupBy(F.col("work_id").alias("_work")).agg(F.count("*").alias("found"))
    made = manifest.join(found, F.col("work_id") == F.col("_work"), "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return made.where(F.coalesce("n_gaps", F.lit(-1)) != F.col("found")).select("work_id", "n_gaps", "found")


def flattened(versions: DataFrame, component: str, sequence: str) -> DataFrame:
    """Versions in the order of their components, then of their sequence, with their place in it."""
    return versions.withColumn("version_no", F.row_number().over(Window.partitionBy(component).orderBy(sequence))).orderBy(component, sequence)


def missing_targets(events: DataFrame, components: DataFrame, pattern: str) -> DataFrame:
    """Events whose target is no known component though it looks like one."""
    return events.where(F.col("target").rlike(pattern)).join(components.select(F.col("component_id").alias("target")), "target", "left_anti")


def minor_difference(a: Column, b: Column, similarity: Column, deep: Column, band: tuple[float, float], lengths: tuple[float, float], least: float) -> Column:
    """Whether a difference in a band of similarity is layout alone: alike enough without marks (``deep``: that similarity), and of about one length."""
    ratio = F.length(a) / F.nullif(F.length(b), F.lit(0))
    return F.coalesce((similarity >= band[0]) & (similarity < band[1]) & (F.length(a) > 0) & ratio.between(*lengths) & (deep >= least), F.lit(False))
