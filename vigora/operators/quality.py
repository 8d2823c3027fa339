"""Reconciliation outcomes, confidence tiers, triage, audits and corpus comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that mean an omission, and reasons that do not count as review.
OMISSIONS = ("[Omitted]", "", "[***]", "[****]")
SOFT_REASONS = ("metadata_only", "format_only", "duplicate_or_superseded")


def is_omitted(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")).isin(*OMISSIONS)


def hard_reasons(found: Column) -> Column:
    return F.array_except(found, F.array(*[F.lit(x) for x in SOFT_REASONS]))


def outcome(as_of_text: Column, has_as_of: Column, future_only: Column, last_omitted: Column, checkpoint: Column, ratio: Column, squeezed_equal: Column, minor: Column) -> Column:
    """What a checkpoint's component and the version in force are to each other; nine outcomes, in this order."""
    size = F.length(as_of_text) / F.greatest(F.lit(1), F.length(checkpoint))
    return (
        F.when(~has_as_of & future_only, "post_checkpoint").when(~has_as_of & last_omitted, "omitted_correct").when(~has_as_of, "missing_reconstruction")
        .when(is_omitted(as_of_text), "omitted_correct").when(as_of_text == checkpoint, "exact").when(squeezed_equal | (ratio >= 0.95), "format_only")
        .when(minor, "minor").when((F.length(checkpoint) < 20) | (size > 3) | (size < 0.33), "comparison_invalid").otherwise("true_substantive_mismatch")
    )


def tier(blocked: Column, portal_missing: Column, incomplete: Column, result: Column, review: Column, has_versions: Column) -> Column:
    """A to D, the first test that holds."""
    return (
        F.when(blocked | portal_missing | incomplete, "D").when(result == "missing_reconstruction", "D")
        .when(result == "comparison_invalid", F.when(review, "C").otherwise("B")).when(result == "true_substantive_mismatch", F.when(review, "D").otherwise("C"))
        .when(result.isin("exact", "format_only"), F.when(review, "B").otherwise("A")).when(result == "minor", "B")
        .when(result == "omitted_correct", F.when(review, "B").otherwise("A")).when(result == "post_checkpoint", "B").when(has_versions, "B").otherwise("D")
    )


def promote(tiers: DataFrame, key: str, parent: Column, text: Column, outside: Column) -> DataFrame:
    """Tier B outside the checkpoint becomes A if its text is an omission or its parent is A."""
    above = tiers.select(F.col(key).alias("_p"), F.col("tier").alias("_t"))
    made = tiers.withColumn("_parent", parent).join(above, F.col("_parent") == F.col("_p"), "left")
    up = (F.col("tier") == "B") & outside & (is_omitted(text) | (F.col("_t") == "A"))
    return made.withColumn("tier", F.when(F.coalesce(up, F.lit(False)), "A").otherwise(F.col("tier"))).drop("_parent", "_p", "_t")


def triage(operation: Column, lane: Column, in_work: Column, has_words: Column) -> Column:
    """(class, action, confidence) of an event under review, the first rule that fits."""
    made = lambda k, a, c: F.struct(F.lit(k).alias("triage"), F.lit(a).alias("action"), F.lit(c).alias("confidence"))
    return (
        F.when(operation.isin("CORRIGENDUM", "RESCIND"), made("special_operation", "defer", 0.90)).when(lane == "forms", made("forms_lane", "route", 0.88))
        .when(operation == "COMMENCE", made("commencement", "defer", 0.82)).when(lane == "metadata_only", made("metadata_only", "auto_reject", 0.84))
        .when(~in_work, made("outside_work", "auto_reject", 0.86)).when(operation != "UNKNOWN", made("needs_parser", "parser", 0.72))
        .when(has_words, made("unknown_operation", "human", 0.62)).otherwise(made("non_operative_text", "auto_reject", 0.68))
    )


def gap_lane(reason: Column) -> Column:
    return (
        F.when(reason.startswith("apply_failed") | reason.startswith("partial_apply"), "text_repair").when(reason.startswith("same_effective_date_conflict"), "sequencing")
        .when(reason.startswith("target_not_in_store"), "anchor").when(reason.startswith("forms"), "forms").when(reason.startswith("metadata"), "metadata").otherwise("event_resolution")
    )


def gap_priority(lane: Column, reason: Column, focus: Column) -> Column:
    return F.lit(0) - F.when(focus, 100).otherwise(0) - F.when(lane == "anchor", 20).otherwise(0) - F.when(lane == "sequencing", 15).otherwise(0) - F.when(reason.startswith("partial"), 10).otherwise(0)


def corpus_diff(base: DataFrame, review: DataFrame, key: str, text: str) -> DataFrame:
    """key, status: added, removed, modified, unchanged. Only hashes meet in the join, not texts."""
    a = base.select(key, F.sha2(text, 256).alias("base_hash"))
    b = review.select(key, F.sha2(text, 256).alias("review_hash"))
    status = F.when(F.col("base_hash").isNull(), "added").when(F.col("review_hash").isNull(), "removed").when(F.col("base_hash") == F.col("review_hash"), "unchanged").otherwise("modified")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def audit(docs: DataFrame, key: str, text: str, longest: int = 2000) -> DataFrame:
    """Per document: paragraphs, longest paragraph, paragraphs over the limit, joined words; flagged if any is long or joined, or there is no paragraph."""
    paragraphs = F.filter(F.transform(F.split(text, r"\n+"), lambda p: F.trim(p)), lambda p: F.length(p) > 0)
    made = docs.withColumn("_p", F.coalesce(paragraphs, F.array().cast("array<string>")))
    made = made.select(
        key, F.size("_p").alias("n_paragraphs"), F.coalesce(F.array_max(F.transform("_p", lambda p: F.length(p))), F.lit(0)).alias("longest"),
        F.size(F.filter("_p", lambda p: F.length(p) > longest)).alias("n_long"), F.coalesce(F.regexp_count(text, F.lit("[a-z]{3,}[A-Z][a-z]{2,}")), F.lit(0)).alias("n_joined"),
    )
    return made.withColumn("flagged", (F.col("n_long") > 0) | (F.col("n_joined") > 0) | (F.col("n_paragraphs") == 0))


def verdict(status: Column, checks: list[tuple[str, Column]], debt: Column) -> Column:
    """(verdict, blocking): exact, exact_with_formatting_debt, ok_with_gaps or failed_verification."""
    blocking = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks]))
    made = F.when(status != "ok", "failed_verification").when(F.size(blocking) > 0, "ok_with_gaps").when(debt, "exact_with_formatting_debt").otherwise("exact")
    return F.struct(made.alias("verdict"), blocking.alias("blocking"))


def formatting_debt(text: Column) -> Column:
    """Zero-width characters, or a footnote mark left behind."""
    return F.coalesce(text, F.lit("")).rlike(r"[\u200b\u200c\u200d\ufeff]|\d+ \[")


def span_errors(archive: DataFrame, key: str, text: str, spans: str) -> DataFrame:
    """Spans (start, end, text_hash) that leave their text, overlap the span before or do not have their hash."""
    from pyspark.sql import Window

    rows = archive.select(key, F.length(text).alias("_n"), F.col(text).alias("_t"), F.posexplode(spans).alias("pos", "s")).select(key, "_n", "_t", "pos", "s.*")
    before = F.max("end").over(Window.partitionBy(key).orderBy("start", "pos").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_before", before)
    tests = F.array_compact(F.array(
        F.when((F.col("start") < 0) | (F.col("end") > F.col("_n")) | (F.col("start") >= F.col("end")), F.lit("out_of_bounds")),
        F.when(F.col("start") < F.col("_before"), F.lit("overlap")),
        F.when(F.sha2(F.expr("substring(_t, start + 1, end - start)"), 256) != F.col("text_hash"), F.lit("hash_mismatch")),
    ))
    return rows.select(key, "pos", "start", "end", tests.alias("errors")).where(F.size("errors") > 0)


def totals(rows: DataFrame, *columns: str) -> DataFrame:
    """Counts of a report by each combination of its columns, with sub-totals and a grand total."""
    return rows.rollup(*columns).agg(F.count("*").alias("n"))
