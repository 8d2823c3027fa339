"""Expressions over tariff codes, serial numbers and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def digits(x: Column | str) -> Column:
    return F.regexp_replace(_c(x), "[^0-9]", "")


def code_list(x: Column | str) -> Column:
    """Codes of two to eight digits in a cell; what stands in brackets is an exclusion and is dropped."""
    parts = F.split(F.regexp_replace(_c(x), r"\[[^\]]*\]", ""), ",")
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"\s+", "")), lambda p: p.rlike(r"^\d{2,8}$"))


def typed_codes(x: Column | str) -> Column:
    """array<struct<kind, code>>: chapters ('Chapter 84') and codes; anything else is dropped."""
    parts = F.filter(F.split(_c(x), "[,;/]"), lambda p: F.length(F.trim(p)) > 0)
    made = F.transform(parts, lambda p: F.when(p.rlike(r"(?i)^\s*chapter\s+\d{1,2}\s*$"), F.struct(F.lit("chapter").alias("kind"), F.lpad(F.regexp_extract(p, r"(\d{1,2})\s*$", 1), 2, "0").alias("code")))
                       .when(F.regexp_replace(p, r"\s+", "").rlike(r"^\d{2,8}$"), F.struct(F.lit("hsn").alias("kind"), F.regexp_replace(p, r"\s+", "").alias("code"))))
    return F.array_compact(made)


def prefixes(code: Column | str, lengths: tuple[int, ...] = (2, 4, 6, 8)) -> Column:
    """A code's own prefixes, so that a prefix match becomes an equi-join."""
    c = _c(code)
    return F.array_distinct(F.array_append(F.filter(F.array(*[F.when(F.length(c) >= n, F.substring(c, 1, n)) for n in lengths]), lambda p: p.isNotNull()), c))


def code_matches(a: Column | str, b: Column | str) -> Column:
    """Equal, or one a prefix of the other."""
    a, b = _c(a), _c(b)
    return (F.length(a) >= 2) & (F.length(b) >= 2) & ((a == b) | F.startswith(a, b) | F.startswith(b, a))


def leading_int(x: Column | str) -> Column:
    return F.regexp_extract(_c(x), r"^\s*(\d+)", 1).try_cast("int")


def serial_key(x: Column | str) -> Column:
    """Natural order of serial numbers: 2, 2A, 3, 10."""
    return F.struct(F.coalesce(leading_int(x), F.lit(2**31 - 1)).alias("n"), F.upper(F.regexp_replace(_c(x), r"^\s*\d+", "")).alias("suffix"))


def serial(x: Column | str) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"[\s.]+", ""))


def has_exclusion(x: Column | str) -> Column:
    return F.coalesce(_c(x), F.lit("")).rlike(r"(?i)other than|excluding|\[[^\]]*\]")


def breakdown(rate: Column, is_cess: Column) -> Column:
    """A rate as its parts: a cess stands alone; else two halves and their double."""
    r = F.round(rate, 4)
    return F.when(is_cess, F.create_map(F.lit("cess"), r)).otherwise(F.create_map(F.lit("cgst"), r, F.lit("sgst"), r, F.lit("igst"), F.round(rate * 2, 4)))


def entry_confidence(kind: Column, similarity: Column, by_model: Column) -> Column:
    """How sure a reconciled entry is; entries read by a model are capped."""
    score = (
        F.when(kind == "exact", 1.0).when(kind == "omitted_match", 0.98).when(kind == "format_only", 0.95)
        .when(similarity >= 0.9, 0.85).when(similarity >= 0.8, 0.75).when(similarity >= 0.6, 0.5).otherwise(0.25)
    )
    return F.when(by_model, F.least(score, F.lit(0.8))).otherwise(score)
