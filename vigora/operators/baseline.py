"""Baselines: cleaning later annotations, flags, repairs, two tracks, children inside parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigora.functions.text import replace_pairs
from vigora.operators.ledger import reasons

#: Annotations that later amendments leave in a printed text.
ANNOTATIONS = (r"\[(?:Inserted|Substituted|Omitted)[^\]]*\]", r"(?i)\b(?:inserted|substituted|omitted)\s+vide\s+notification[^.;]*[.;]?", r"(?m)^\s*\d{1,3}\s*(?:Subs|Ins|Omitted)\.\s+by[^\n]*$", r"(?i)\bw\.e\.f\.\s*\d{1,2}[./-]\d{1,2}[./-]\d{4}")


def decontaminate(text: Column) -> Column:
    for p in ANNOTATIONS:
        text = F.regexp_replace(text, p, "")
    return F.trim(F.regexp_replace(text, r"[ \t]{2,}", " "))


def flags(text: Column, label: Column) -> Column:
    """What is wrong with a baseline component."""
    return reasons([("empty", F.length(F.trim(F.coalesce(text, F.lit("")))) == 0), ("annotated", F.coalesce(text, F.lit("")).rlike("|".join(ANNOTATIONS[:2]))), ("dot_leaders", F.coalesce(text, F.lit("")).rlike(r"\.{5,}")), ("no_label", F.coalesce(label, F.lit("")) == ""), ("page_furniture", F.coalesce(text, F.lit("")).rlike(r"(?i)page \d+ of \d+"))])


def cleaned(components: DataFrame, after: Column) -> DataFrame:
    """Without components inserted after the base, texts cleaned. Added: action (kept, cleaned)."""
    made = components.where(~F.coalesce(after, F.lit(False))).withColumn("_t", decontaminate(F.col("text")))
    return made.withColumn("action", F.when(F.col("_t") == F.col("text"), "kept").otherwise("cleaned")).withColumn("text", F.col("_t")).drop("_t")


def repair(components: DataFrame, source: DataFrame, within: Column) -> DataFrame:
    """Components of a range take the source's text if it differs and has no flags. Added: repair."""
    s = source.select(F.col("component_id").alias("_id"), F.col("text").alias("_s"), F.size(flags(F.col("text"), F.col("label"))).alias("_f"))
    made = components.join(s, F.col("component_id") == F.col("_id"), "left")
    state = F.when(~within | F.col("_id").isNull() | (F.col("_s") == F.col("text")), "unchanged").when(F.col("_f") == 0, "repaired").otherwise("replacement_rejected")
    made = made.withColumn("repair", state)
    return made.withColumn("text", F.when(F.col("repair") == "repaired", F.col("_s")).otherwise(F.col("text"))).drop("_id", "_s", "_f")


def tracks(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two readings of a baseline: a component on which they disagree is blocked. Added: blocked, block_reasons."""
    other = second.select(F.col("component_id").alias("_id"), F.sha2("text", 256).alias("_h"))
    made = first.join(other, F.col("component_id") == F.col("_id"), "left")
    why = reasons([("second_track_missing", F.col("_id").isNull()), ("tracks_disagree", F.col("_id").isNotNull() & (F.sha2("text", 256) != F.col("_h")))])
    return made.withColumn("block_reasons", why).withColumn("blocked", F.array_contains("block_reasons", "tracks_disagree")).drop("_id", "_h")


def merged_children(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Parents with each child's baseline body replaced by its present one, first occurrence, in the order of the ids. children: parent_id, component_id, base_text, now_text."""
    pairs = children.where(F.length("base_text") > 0).groupBy(F.col("parent_id").alias("_p")).agg(F.transform(F.array_sort(F.collect_list(F.struct("component_id", "base_text", "now_text"))), lambda c: F.struct(c.base_text.alias("old"), c.now_text.alias("new"))).alias("_pairs"))
    made = parents.join(pairs, F.col("component_id") == F.col("_p"), "left")
    return made.withColumn("text", F.when(F.col("_pairs").isNotNull(), replace_pairs(F.col("text"), F.col("_pairs"))).otherwise(F.col("text"))).drop("_p", "_pairs")


def blocked_targets(events: DataFrame, blocked: DataFrame, target: str) -> DataFrame:
    """Events at a blocked component or below one: ancestors are exploded from the target, so the test is an equi-join. Added: blocked_by."""
    parts = F.split(target, "/")
    ancestors = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    hits = events.select(F.col(target).alias("_t"), F.explode(ancestors).alias("_a")).distinct().join(blocked.select(F.col("component_id").alias("_a")).distinct(), "_a")
    first = hits.groupBy("_t").agg(F.min("_a").alias("blocked_by"))
    return events.join(first, F.col(target) == F.col("_t"), "left").drop("_t")
