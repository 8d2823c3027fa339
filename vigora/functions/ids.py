"""Expressions over canonical ids: slash-separated paths whose prefixes are their ancestors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_ancestor(a: Column | str, b: Column | str) -> Column:
    return F.startswith(_c(b), F.concat(_c(a), F.lit("/")))


def overlaps(a: Column | str, b: Column | str) -> Column:
    """Equal, or one is an ancestor of the other."""
    return (_c(a) == _c(b)) | is_ancestor(a, b) | is_ancestor(b, a)


def work_of(x: Column | str) -> Column:
    """The work a component belongs to: what stands before its rule or section."""
    x = _c(x)
    return F.when(F.contains(x, F.lit("/rule/")), F.substring_index(x, "/rule/", 1)).when(F.contains(x, F.lit("/section/")), F.substring_index(x, "/section/", 1))


def parent_of(x: Column | str) -> Column:
    """The rule of a sub-rule, the section of a sub-section; null elsewhere."""
    x = _c(x)
    return F.when(F.contains(x, F.lit("/subrule/")), F.substring_index(x, "/subrule/", 1)).when(F.contains(x, F.lit("/subsection/")), F.substring_index(x, "/subsection/", 1))


def kind_of(x: Column | str) -> Column:
    """act, act_section, rule, form, notification or other."""
    kind, x = F.get(F.split(_c(x), "/"), F.lit(3)), _c(x)
    return (
        F.when((kind == "acts") & F.contains(x, F.lit("/section/")), "act_section").when(kind == "acts", "act")
        .when(kind == "rules", "rule").when(kind == "forms", "form").when(kind == "notifications", "notification").otherwise("other")
    )


def document_of(x: Column | str) -> Column:
    """The owning document: four segments, seven for notifications."""
    parts = F.split(_c(x), "/")
    return F.when(kind_of(x) == "notification", F.concat_ws("/", F.slice(parts, 1, 8))).otherwise(F.concat_ws("/", F.slice(parts, 1, 5)))


def normalised_component(x: Column | str) -> Column:
    """Labels without leading zeros, letter suffixes in capitals: .../rule/08a and .../rule/8A are one."""
    label = F.regexp_extract(_c(x), r"/(?:rule|section|subrule)/0*(\d+)([a-z]*)", 0)
    fixed = F.regexp_replace(label, r"/0+(\d)", "/$1")
    upper = F.concat(F.regexp_extract(fixed, r"^(/\w+/\d+)", 1), F.upper(F.regexp_extract(fixed, r"\d([a-z]*)$", 1)))
    return F.when(label == "", _c(x)).otherwise(F.replace(_c(x), label, upper))


def slug(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", "-"), F.lit("-"))


def file_slug(x: Column | str) -> Column:
    """A path as a file name; very long ones end in a hash."""
    made = F.regexp_replace(F.regexp_replace(_c(x), "^/", ""), "[^A-Za-z0-9._-]+", "-")
    return F.when(F.length(made) > 200, F.concat(F.substring(made, 1, 189), F.lit("-"), F.substring(F.sha2(_c(x), 256), 1, 10))).otherwise(made)


def safe_eid(x: Column | str) -> Column:
    made = F.regexp_replace(_c(x), "[^A-Za-z0-9_.-]+", "_")
    return F.when(made.rlike("^[A-Za-z_]"), made).otherwise(F.concat(F.lit("_"), made))


def relationship(x: Column | str) -> Column:
    """A graph relationship type of capitals, digits and underscores."""
    made = F.trim(F.regexp_replace(F.upper(F.coalesce(_c(x), F.lit(""))), "[^A-Z0-9]+", "_"), F.lit("_"))
    return F.when(made == "", "RELATED_TO").when(made.rlike("^[0-9]"), F.concat(F.lit("REL_"), made)).otherwise(made)


def event_id(family: str, document: Column, start: Column, end: Column, text_hash: Column) -> Column:
    return F.concat(F.lit(f"evt_{family}_"), F.substring(F.sha2(F.concat_ws("|", document, start.cast("string"), end.cast("string"), text_hash), 256), 1, 16))


def version_id(component: Column, valid_from: Column, event: Column, text_hash: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", component, valid_from.cast("string"), F.coalesce(event.cast("string"), F.lit("")), text_hash), 256), 1, 24)


def legal_date(x: Column | str) -> Column:
    """'1st day of July, 2017', '31st October, 2025', 01.07.2017, ISO: the first such date in the text; null if there is none."""
    x = _c(x)
    named = F.regexp_replace(F.regexp_extract(x, r"(?i)(\d{1,2})(?:st|nd|rd|th)?\s+(?:day\s+of\s+)?([A-Z][a-z]{2,8}),?\s+(\d{4})", 0), r"(?i)(?<=\d)(?:st|nd|rd|th)|\bday\s+of\b|,", " ")
    named = F.initcap(F.trim(F.regexp_replace(named, r"\s+", " ")))
    dotted = F.regexp_extract(x, r"\b(\d{1,2})[./-](\d{1,2})[./-](\d{4})\b", 0)
    iso = F.regexp_extract(x, r"\b\d{4}-\d{2}-\d{2}\b", 0)
    tries = [F.try_to_date(iso, "yyyy-MM-dd"), F.try_to_date(named, "d MMMM yyyy"), F.try_to_date(named, "d MMM yyyy"), F.try_to_date(F.regexp_replace(dotted, "[./-]", "."), "d.M.yyyy")]
    return F.coalesce(*tries)


def resolution(target: Column, known: Column, alias_document: Column, alias_known: Column, document_known: Column) -> Column:
    """Six ways a reference can end; the order is part of the meaning."""
    return (
        F.when(~F.startswith(target, F.lit("/in/")), "external_or_literal").when(known, "resolved")
        .when(alias_document & alias_known, "resolved_by_alias").when(alias_document, "alias_document_exists_child_missing")
        .when(document_known, "document_exists_missing_child").when(F.startswith(target, F.lit("/in/union/forms/")), "form_missing").otherwise("document_missing")
    )
