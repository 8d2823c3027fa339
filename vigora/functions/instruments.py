"""Expressions over instruments, locators, labels and the effects that clauses have."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigora.functions.text import first_given, squeeze

# Words and forms that the documents use.
REFERENCE_KINDS = r"(?i)(?:section|rule|clause|sub-section|sub-rule|article)\s+\d+[a-z]?"
YEARS = r"\b(?:19|20)\d{2}\b"
AMOUNTS = r"\b\d{1,3}(?:,\d{2,3})+\b"
PERCENTAGES = r"(?i)\b\d+(?:\.\d+)?\s*per\s*cent\b"
WORDED_PERCENTAGES = r"(?i)\b(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|fifteen|twenty|fifty|hundred)\s+per\s+cent\b"
AMENDING = r"\bshall\s+be\s+(?:inserted|substituted|omitted)\b"
NOTICES = r"notification of the government|notification issued|g\.s\.r\."
RETROSPECTION = r"\bretrospective(?:ly)?\b|\bexemption\s+from,\s+or\s+levy\s+or\s+collection\b|\bshall\s+be\s+deemed\s+to\s+have\b.*\bcome\s+into\s+force\b"
SCHEDULE_EFFECT = r"\bin\s+schedule\s+[ivxlcdm]+\s+to\s+(?:the\s+principal\s+act|the\s+central\s+goods\s+and\s+services\s+tax\s+act)|\bamendment\s+of\s+schedule\s+[ivxlcdm]+\b"
FAMILIES = {"INSERT_CHILD": "INSERT", "INSERT_SIBLING": "INSERT", "SPLICE": "TEXT_EDIT", "SUBSTITUTE": "TEXT_EDIT"}


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _number(x: Column) -> Column:
    """Digits without leading zeros, null if there are none."""
    return F.nullif(F.regexp_replace(x, r"^0+(?=\d)", ""), F.lit(""))


def instrument_parts(instrument: Column | str, issued: Column | str, record: Column | str) -> Column:
    """struct<number, year> of "12/2017": else the first whole number, or the record's id, and the year of issue."""
    x = F.coalesce(_c(instrument), F.lit(""))
    both = r"(\d+)\s*/\s*(\d{4})"
    number = F.coalesce(_number(F.regexp_extract(x, both, 1)), _number(F.regexp_extract(x, r"\b(\d+)\b", 1)), _c(record).cast("string"), F.lit("unknown"))
    year = F.coalesce(F.nullif(F.regexp_extract(x, both, 2), F.lit("")), F.substring(_c(issued).cast("string"), 1, 4), F.lit("undated"))
    return F.struct(number.alias("number"), year.alias("year"))


def notification_document(root: str, category: Column, parts: Column, corrigendum: Column, record: Column | str) -> Column:
    """The id of a notification's document, below ``root``; corrigenda go by their record."""
    suffix = F.when(corrigendum, F.concat(F.lit("corrigendum-"), _c(record).cast("string"))).otherwise(F.concat_ws("-", parts["number"], parts["year"]))
    return F.concat_ws("/", F.lit(root), category, parts["year"], suffix)


def short_notification(path: Column | str) -> Column:
    """".../central-tax-rate/2017/1-2017-..." as 1/2017-ct-rate; cess instruments keep apart by their own ending."""
    x = F.coalesce(_c(path), F.lit(""))
    form = r"/(\d{4})/(\d+)-\d+-"
    ending = F.when(F.contains(x, F.lit("compensation-cess-rate")), "-cc-rate").when(F.contains(x, F.lit("central-tax-rate")), "-ct-rate").otherwise("")
    return F.when(x.rlike(form), F.concat(F.regexp_extract(x, form, 2), F.lit("/"), F.regexp_extract(x, form, 1), ending)).otherwise(x)


def rate_locator(raw: Column | str, known: list[str]) -> Column:
    """struct<target, schedule, code, serial> of "11/2017::sno=3"; a bare target has to be known; a date after @ is no part of it."""
    x = F.trim(_c(raw))
    detailed = F.contains(x, F.lit("::"))
    target = F.when(detailed, F.substring_index(x, "::", 1)).when(x.isin(*known), x)
    spec = F.when(detailed, F.regexp_replace(x, r"(?s)^.*?::", ""))
    part = lambda pattern: F.nullif(F.regexp_extract(spec, pattern, 1), F.lit(""))
    return F.struct(target.alias("target"), part("schedule=([IVX0-9]+)").alias("schedule"), part("hsn=([0-9]+)").alias("code"), part("sno=([0-9A-Za-z.]+)").alias("serial"))


def operation_family(operation: Column | str) -> Column:
    x = F.coalesce(_c(operation), F.lit(""))
    return reduce(lambda found, pair: found.when(x == pair[0], pair[1]), list(FAMILIES.items())[1:], F.when(x == "INSERT_CHILD", "INSERT")).otherwise(x)


def notification_ref(*candidates: Column | str) -> Column:
    """"07/2019" from the first candidate that has a number and a year; the number has two digits at least."""
    form = r"(?<!\d)(\d{1,3})[/-](\d{4})(?!\d)"

    def one(c):
        number = F.regexp_extract(c, form, 1).try_cast("int").cast("string")
        return F.when(c.rlike(form), F.concat(F.lpad(number, F.greatest(F.lit(2), F.length(number)), F.lit("0")), F.lit("/"), F.regexp_extract(c, form, 2)))

    return F.coalesce(*[one(F.coalesce(_c(c), F.lit(""))) for c in candidates])


def form_label(x: Column | str) -> Column:
    """"FORM GST REG 01" and "gst-reg-01" get alike: no blanks or marks but hyphens, one after the letters if there is none."""
    label = F.regexp_replace(F.lower(_c(x)), "[^a-z0-9-]+", "")
    return F.when(F.contains(label, F.lit("-")), label).otherwise(F.regexp_replace(label, r"^([a-z]+)([0-9])", "$1-$2"))


def legal_difference(a: Column | str, b: Column | str) -> Column:
    """Whether two texts name other provisions, years, amounts or percentages."""
    def found(x, pattern):
        return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(_c(x), F.lit("")), F.lit(pattern), F.lit(0))))

    return reduce(lambda x, y: x | y, [found(a, p) != found(b, p) for p in (REFERENCE_KINDS, YEARS, AMOUNTS, PERCENTAGES, WORDED_PERCENTAGES)])


def same_substance(a: Column, b: Column, label: Column, most: int = 80) -> Column:
    """Equal under letters and digits, or one ends with the other after a short start that holds the component's label."""
    a, b, label = squeeze(a), squeeze(b), squeeze(label)
    long, short = F.when(F.length(a) >= F.length(b), a).otherwise(b), F.when(F.length(a) >= F.length(b), b).otherwise(a)
    start = F.substring(long, F.lit(1), F.length(long) - F.length(short))
    return (a == b) | (F.length(label) > 0) & F.endswith(long, short) & F.contains(start, label) & (F.length(start) <= most)


def event_date(*dates: Column | str) -> Column:
    """When an event counts: the first given of its dates, empty if none."""
    return F.coalesce(first_given(*dates), F.lit(""))


def metadata_only_effect(x: Column | str) -> Column:
    """A clause on notifications alone - retrospection, exemption, deemed commencement - that changes no provision's text."""
    low = F.lower(F.coalesce(_c(x), F.lit("")))
    return ~F.contains(low, F.lit("schedule iii")) & ~low.rlike(AMENDING) & low.rlike(NOTICES) & low.rlike(RETROSPECTION)


def schedule_effect(x: Column | str) -> Column:
    """A clause that amends a schedule of the act."""
    return F.lower(F.coalesce(_c(x), F.lit(""))).rlike(SCHEDULE_EFFECT)


def commencement_blocked(operation: Column, reasons: Column, triage: Column, blockers: Column) -> Column:
    """Whether an event waits for a commencement date."""
    has = lambda c, v: F.coalesce(F.array_contains(c, v), F.lit(False))
    return F.coalesce(triage == "commencement_only", F.lit(False)) | F.coalesce(operation == "COMMENCE", F.lit(False)) | has(reasons, "date_not_resolved") | has(blockers, "unresolved_commencement")


def section_score(label: str, x: Column | str) -> Column:
    """How much a text looks like the body of a section: named, named at its start, long, and no note on amendments."""
    import re

    c, name = F.coalesce(_c(x), F.lit("")), re.escape(label)
    score = lambda test, n: F.when(test, n).otherwise(0)
    return (
        score(c.rlike(rf"(?i)\bSection\s+{name}\b"), 100) + score(c.rlike(rf"(?i)^\*?\s*Section\s+{name}\b"), 100)
        + score(c.rlike(r"(?i)\b(inserted|substituted|omitted|vide notification|finance act)\b"), -25) + score(F.length(c) > 250, 25)
    )
