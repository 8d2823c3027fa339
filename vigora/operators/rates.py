"""Rate tables: ledgers by code and date, points in time, validation, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigora.functions.codes import has_exclusion, leading_int, prefixes
from vigora.functions.text import jaccard, similarity, squeeze, tokens


def ledger(snapshots: DataFrame, codes: Column, date: str) -> DataFrame:
    """A row for each code and date, the last entry of a date wins. snapshots: date, seq, rate and what else a row has."""
    rows = snapshots.withColumn("code", F.explode(codes))
    return rows.groupBy("code", date).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("code", date)]), F.col("seq")).alias("r")).select("code", date, "r.*")


def current(rows: DataFrame, date: str) -> DataFrame:
    return rows.groupBy("code").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "code"]), F.col(date)).alias("r")).select("code", "r.*")


def at(rows: DataFrame, date: str, when: Column) -> DataFrame:
    """Each code's last entry on or before a date."""
    return current(rows.where(F.col(date) <= when), date)


def match_codes(queries: DataFrame, query: str, entries: DataFrame, code: str) -> DataFrame:
    """Queries with the entries whose code is theirs, begins theirs or begins with theirs.

    Both sides are exploded to their prefixes of even length, which turns the
    prefix test into an equi-join; codes match if one equals a prefix of the other.
    """
    q = queries.withColumn("_p", F.explode(prefixes(query)))
    exact = q.join(entries, F.col("_p") == F.col(code)).drop("_p")
    e = entries.withColumn("_p", F.explode(prefixes(code)))
    longer = queries.join(e, (F.col(query) == F.col("_p")) & (F.col(code) != F.col(query))).drop("_p")
    return exact.unionByName(longer.select(*exact.columns)).where((F.length(query) >= 2) & (F.length(code) >= 2))


def duplicate_serials(entries: DataFrame, group: list[str], serial: Column, pos: str, omitted: Column) -> DataFrame:
    """Entries whose serial stands earlier in their schedule; omitted and blank ones are no entries."""
    rows = entries.withColumn("_key", serial).where(~omitted & (F.col("_key") != ""))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*group, "_key").orderBy(pos))).where("_n > 1").drop("_n")


def serial_disorder(entries: DataFrame, group: list[str], number: Column, pos: str, omitted: Column) -> DataFrame:
    """Entries whose number is under the row's before; omitted rows count as a row before, but not as a finding."""
    rows = entries.withColumn("_num", number).where("_num IS NOT NULL")
    return rows.withColumn("previous", F.lag("_num").over(Window.partitionBy(*group).orderBy(pos))).where((F.col("_num") < F.col("previous")) & ~omitted).drop("_num")


def serial_gaps(entries: DataFrame, group: list[str], number: Column) -> DataFrame:
    """Numbers from 1 to the largest that a schedule lacks. Gaps lie between neighbours in order, so nothing is generated but the gaps."""
    rows = entries.select(*group, number.alias("n")).where("n IS NOT NULL AND n > 0").distinct()
    rows = rows.withColumn("before", F.coalesce(F.lag("n").over(Window.partitionBy(*group).orderBy("n")), F.lit(0)))
    return rows.where("n > before + 1").select(*group, F.explode(F.sequence(F.col("before") + 1, F.col("n") - 1)).alias("missing"))


def implausible(entries: DataFrame, group: list[str], number: Column) -> DataFrame:
    """Numbers over max(100, 3 * entries of the schedule)."""
    sizes = entries.groupBy(*group).agg(F.count("*").alias("_n"))
    return entries.withColumn("_num", number).where("_num > 100").join(sizes, group).where(F.col("_num") > 3 * F.col("_n")).select(*entries.columns)


def code_overlap(entries: DataFrame, code: str, schedule: str, description: Column) -> DataFrame:
    """Codes in two schedules or more; a chapter is benign if an entry has an exclusion."""
    made = entries.groupBy(code).agg(F.countDistinct(schedule).alias("n_schedules"), F.array_sort(F.collect_set(schedule)).alias("schedules"), F.max(has_exclusion(description).cast("int")).alias("_x"))
    return made.where("n_schedules >= 2").withColumn("kind", F.when((F.length(code) == 2) & (F.col("_x") == 1), "benign").when(F.length(code) == 2, "hsn_overlap_chapter").otherwise("hsn_overlap")).drop("_x")


def chapter_subsumption(entries: DataFrame, code: str, schedule: str, description: Column) -> DataFrame:
    """Chapters that hold longer codes of other schedules and exclude nothing."""
    short = entries.where(F.length(code) == 2).groupBy(F.col(code).alias("chapter"), F.col(schedule).alias("in_schedule")).agg(F.max(has_exclusion(description).cast("int")).alias("x")).where("x = 0").drop("x")
    long = entries.where(F.length(code) > 2).select(F.substring(code, 1, 2).alias("chapter"), F.col(code).alias("code"), F.col(schedule).alias("other")).distinct()
    return short.join(long, "chapter").where("in_schedule <> other")


def exempt_conflict(rate: DataFrame, exempt: DataFrame, code: str) -> DataFrame:
    return rate.select(code).intersect(exempt.select(code))


def changes(rows: DataFrame, key: str, date: str, state: Column, *order: str) -> DataFrame:
    from vigora.operators.temporal import change_points

    return change_points(rows, key, date, state, *order)


def concordance(pre: DataFrame, post: DataFrame, keys: list[tuple[str, float, list[tuple[Column, Column]]]], pre_id: str, post_id: str, order: str) -> DataFrame:
    """Each old entry's best new one: the first way of matching that has a hit, then the first new entry. keys: (name, confidence, pairs of join expressions over pre and post)."""
    hits = []
    for priority, (name, confidence, pairs) in enumerate(keys):
        left = pre.select(F.col(pre_id), *[a.alias(f"_k{i}") for i, (a, _) in enumerate(pairs)])
        right = post.select(F.col(post_id), F.col(order).alias("_o"), *[b.alias(f"_k{i}") for i, (_, b) in enumerate(pairs)])
        # One new entry for each key is enough, for the first wins.
        right = right.groupBy(*[f"_k{i}" for i in range(len(pairs))]).agg(F.min_by(post_id, F.struct("_o", post_id)).alias(post_id))
        hits.append(left.join(right, [f"_k{i}" for i in range(len(pairs))]).select(pre_id, post_id, F.lit(priority).alias("_p"), F.lit(name).alias("how"), F.lit(confidence).alias("confidence")))
    best = reduce(DataFrame.unionByName, hits).groupBy(pre_id).agg(F.min_by(F.struct(post_id, "how", "confidence"), F.col("_p")).alias("b"))
    return pre.select(pre_id).join(best, pre_id, "left").select(pre_id, f"b.{post_id}", F.coalesce("b.how", F.lit("unmatched")).alias("how"), F.coalesce("b.confidence", F.lit(0.0)).alias("confidence"))


def pair_class(cp_text: Column, mat_text: Column, cp_code: Column, mat_code: Column, cp_omitted: Column, mat_omitted: Column, ratio: Column) -> Column:
    """What a checkpoint entry and a materialised one are to each other; the first test that holds."""
    a, b = squeeze(cp_text), squeeze(mat_text)
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    codes_differ = (cp_code != "") & (mat_code != "") & (cp_code != mat_code)
    words = jaccard(tokens(cp_text), tokens(mat_text))
    within = (short >= 10) & (F.contains(a, b) | F.contains(b, a)) & (long > 0)
    return (
        F.when(cp_omitted & mat_omitted, "omitted_match").when(cp_omitted, "cp_omitted_mat_active").when(mat_omitted, "mat_omitted_cp_active")
        .when(codes_differ & (ratio >= 0.8), "format_only").when(codes_differ, "tariff_mismatch").when(a == b, "exact")
        .when((short == 0) | a.isin("allgoods") | b.isin("allgoods"), "format_only").when(within | (ratio >= 0.8) | (words >= 0.85), "format_only").otherwise("description_mismatch")
    )


def reconcile(checkpoint: DataFrame, materialised: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on schedule and serial with a class for each pair; leftovers are missing on one side. Both: keys, code, text, omitted."""
    cp = checkpoint.select(*keys, F.col("code").alias("cp_code"), F.col("text").alias("cp_text"), F.col("omitted").alias("cp_omitted"), F.lit(True).alias("_cp"))
    mat = materialised.select(*keys, F.col("code").alias("mat_code"), F.col("text").alias("mat_text"), F.col("omitted").alias("mat_omitted"), F.lit(True).alias("_mat"))
    # Only pairs whose class rests on it are compared in Python: both in force, their texts unlike.
    active = lambda side: ~F.coalesce(F.col(f"{side}_omitted"), F.lit(False))
    compared = F.col("_cp") & F.col("_mat") & active("cp") & active("mat") & ~F.col("cp_text").eqNullSafe(F.col("mat_text"))
    made = cp.join(mat, keys, "full_outer").withColumn("ratio", similarity(F.when(compared, F.coalesce("cp_text", F.lit(""))), F.when(compared, F.coalesce("mat_text", F.lit("")))))
    made = made.withColumn("ratio", F.when(F.col("_cp") & F.col("_mat") & F.col("ratio").isNull(), F.when(F.col("cp_text").eqNullSafe(F.col("mat_text")), 1.0).otherwise(0.0)).otherwise(F.col("ratio")))
    both = pair_class(F.coalesce("cp_text", F.lit("")), F.coalesce("mat_text", F.lit("")), F.coalesce("cp_code", F.lit("")), F.coalesce("mat_code", F.lit("")), F.coalesce("cp_omitted", F.lit(False)), F.coalesce("mat_omitted", F.lit(False)), F.coalesce("ratio", F.lit(0.0)))
    kind = F.when(F.col("_mat").isNull(), F.when(F.col("cp_omitted"), "cp_omitted_mat_missing").otherwise("missing_in_materialised")).when(F.col("_cp").isNull(), F.when(F.col("mat_omitted"), "mat_omitted_cp_missing").otherwise("missing_in_checkpoint")).otherwise(both)
    return made.withColumn("class", kind).drop("_cp", "_mat")


def rematch(left: DataFrame, right: DataFrame, group: str, code: Column, left_id: str, right_id: str, width: int = 4) -> DataFrame:
    """Leftovers of both sides that share a code prefix no other leftover has: left id, right id."""
    single = lambda d, i: d.withColumn("_p", F.substring(code, 1, width)).where(F.length("_p") == width).groupBy(group, "_p").agg(F.min(i).alias(i), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return single(left, left_id).join(single(right, right_id), [group, "_p"]).select(left_id, right_id)


def validate(entries: DataFrame, group: str, serial: Column, pos: str, code: str, description: Column, omitted: Column) -> DataFrame:
    """All findings of a schedule set: severity, check, grp, detail."""
    number = leading_int(serial)
    found = [
        duplicate_serials(entries, [group], serial, pos, omitted).select(F.lit("error").alias("severity"), F.lit("duplicate_sno").alias("check"), F.col(group).cast("string").alias("grp"), serial.alias("detail")),
        serial_disorder(entries, [group], number, pos, omitted).select(F.lit("error").alias("severity"), F.lit("sno_out_of_order").alias("check"), F.col(group).cast("string").alias("grp"), serial.alias("detail")),
        serial_gaps(entries, [group], number).select(F.lit("error").alias("severity"), F.lit("sno_gap").alias("check"), F.col(group).cast("string").alias("grp"), F.col("missing").cast("string").alias("detail")),
        implausible(entries, [group], number).select(F.lit("error").alias("severity"), F.lit("sno_value_anomaly").alias("check"), F.col(group).cast("string").alias("grp"), serial.alias("detail")),
        code_overlap(entries, code, group, description).where("kind <> 'benign'").select(F.lit("warning").alias("severity"), F.col("kind").alias("check"), F.array_join("schedules", ",").alias("grp"), F.col(code).alias("detail")),
        chapter_subsumption(entries, code, group, description).select(F.lit("warning").alias("severity"), F.lit("chapter_subsumption").alias("check"), F.col("in_schedule").cast("string").alias("grp"), F.col("code").alias("detail")),
    ]
    return reduce(DataFrame.unionByName, found)


def post_entry(concordance: DataFrame, schedule: Column, serial: Column) -> DataFrame:
    """The row of a concordance for a schedule and serial; a full stop after the serial does not matter."""
    return concordance.where((F.col("pre_schedule") == schedule) & (F.col("pre_sno") == F.rtrim(F.regexp_replace(serial, r"\.+$", "")))).limit(1)


def gap_fill(report: DataFrame, concordance: DataFrame, width: int = 4) -> DataFrame:
    """A report's entries that are missing in the materialised schedules, as traced where the concordance has their schedule and code prefix.

    report: schedule, code, class. concordance (matched and unmatched): pre_schedule, pre_code.
    """
    known = concordance.select(F.col("pre_schedule").alias("_s"), F.substring(F.trim("pre_code"), 1, width).alias("_p")).where(F.length("_p") == width).distinct()
    own = F.substring(F.trim("code"), 1, width)
    made = report.join(known, (F.col("schedule") == F.col("_s")) & (own == F.col("_p")), "left")
    traced = (F.col("class") == "missing_in_materialised") & F.col("_s").isNotNull()
    return made.withColumn("class", F.when(traced, "concordance_traced").otherwise(F.col("class"))).drop("_s", "_p")


def concessions(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """Queries with the concessional entries of their code in force at their date: kind 'exemption' where the rate is 0, else 'concession', and the doubled rate.

    queries: code, date. entries: code, notification, rate, effective (null: always), and what else they have.
    """
    made = queries.withColumnRenamed("code", "_code").join(entries, F.col("_code") == F.col("code")).where(F.col("effective").isNull() | (F.col("date") >= F.col("effective")))
    return made.drop("_code").withColumn("kind", F.when(F.col("rate") == 0, "exemption").otherwise("concession")).withColumn("total_rate", F.col("rate") * 2)


def conditions(entries: DataFrame, inherited: DataFrame) -> DataFrame:
    """Entries with what they inherit from their schedule: heading, opening words, explanations; entries of schedules without any keep nulls. inherited: notification, schedule and its texts."""
    return entries.join(inherited, ["notification", "schedule"], "left")

