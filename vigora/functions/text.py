"""Text expressions: cleaning, tokens, snippets, hashes; Arrow functions where offsets or diffs are needed."""

from __future__ import annotations

import difflib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x: Column | str, limit: int = 0) -> Column:
    """White space to single blanks, trimmed; with a limit, cut with an ellipsis."""
    made = F.trim(F.regexp_replace(_c(x), r"\s+", " "))
    return F.when(F.length(made) > limit, F.concat(F.rtrim(F.substring(made, 1, limit - 1)), F.lit("…"))).otherwise(made) if limit else made


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(_c(x), F.lit(""))


def first_given(*xs: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(x) for x in xs])


def tokens(x: Column | str) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(_c(x)), F.lit("[a-z0-9]+"), F.lit(0))


def query_terms(x: Column | str) -> Column:
    """Tokens of three characters or more."""
    return F.filter(tokens(x), lambda t: F.length(t) > 2)


def text_hash(x: Column | str) -> Column:
    return F.sha2(_c(x), 256)


def squeeze(x: Column | str) -> Column:
    """Lower-case letters and digits only: two texts that differ in layout alone are equal under it."""
    return F.regexp_replace(F.lower(_c(x)), "[^0-9a-z]+", "")


def snippet(x: Column | str, terms: list[str], phrase: str = "", size: int = 260) -> Column:
    """About ``size`` characters around the phrase, else around the earliest of the terms, with ellipses where it is cut; the bare start where none occurs."""
    text = clean(x)
    low = F.lower(text)
    place = lambda w: F.nullif(F.locate(w.lower(), low), F.lit(0))
    found = [place(w) for w in dict.fromkeys(terms) if w]
    earliest = F.least(*found) if len(found) > 1 else found[0] if found else F.lit(None).cast("int")
    hit = F.coalesce(place(phrase), earliest) if phrase else earliest
    start = F.greatest(F.lit(1), hit - size // 3)
    around = F.concat(F.when(start > 1, "...").otherwise(""), F.trim(F.substring(text, start, F.lit(size))), F.when(start + size - 1 < F.length(text), "...").otherwise(""))
    return F.when(hit.isNotNull(), around).otherwise(F.substring(text, 1, size))


def clauses(x: Column | str, words: list[str], most: int = 5, width: int = 400) -> Column:
    """The first sentences that hold any of the words."""
    parts = F.split(_c(x), r"(?<=[.;])\s+")
    pattern = "(?i)" + "|".join(re.escape(w) for w in words)
    return F.slice(F.transform(F.filter(parts, lambda p: p.rlike(pattern)), lambda p: F.substring(F.trim(p), 1, width)), 1, most)


def replace_first(x: Column, old: Column, new: Column) -> Column:
    """The first occurrence only; unchanged where there is none."""
    at = F.instr(x, old)
    return F.when((F.length(old) > 0) & (at > 0), F.overlay(x, new, at, F.length(old))).otherwise(x)


def replace_pairs(x: Column, pairs: Column) -> Column:
    """Ordered (old, new) pairs, each on its first occurrence; pairs: array<struct<old, new>>."""
    return F.aggregate(pairs, x, lambda t, p: replace_first(t, p["old"], p["new"]))


#: What an inserted text needs no blank before.
CLOSING = ",.;:)]}"


def insert_blanks(before: str, insert: str, after: str) -> str:
    """An inserted text with a blank at each end where neither it nor its neighbour has one; none before closing marks."""
    left = " " if insert and before and not insert[0].isspace() and not before[-1].isspace() else ""
    right = " " if insert and after and not insert[-1].isspace() and not after[0].isspace() and after[0] not in CLOSING else ""
    return left + insert + right


def prepared_insert(before: Column, insert: Column, after: Column) -> Column:
    """``insert_blanks`` as a column."""
    some = F.length(insert) > 0
    left = F.when(some & before.rlike(r"\S$") & insert.rlike(r"^\S"), " ").otherwise("")
    right = F.when(some & insert.rlike(r"\S$") & after.rlike(r"^[^\s,.;:)\]}]"), " ").otherwise("")
    return F.concat(left, insert, right)


# --- offset-aware functions -------------------------------------------------

_FOLD = {0x2018: "'", 0x2019: "'", 0x201C: '"', 0x201D: '"', 0x2010: "-", 0x2011: "-", 0x2012: "-", 0x2013: "-", 0x2014: "-", 0x00A0: " "}


def normalised_with_map(text: str) -> tuple[str, list[int]]:
    """The text after NFKC, folded quotes and dashes, no footnote marks, single blanks, lower case; and where each character came from."""
    out, where = [], []
    for at, c in enumerate(text):
        for n in unicodedata.normalize("NFKC", c.translate(_FOLD)).translate(_FOLD).lower():
            if n.isspace():
                if out and out[-1] != " ":
                    out.append(" ")
                    where.append(at)
            else:
                out.append(n)
                where.append(at)
    joined = "".join(out)
    for m in reversed(list(re.finditer(r"\[?\d{1,3}\](?=\S)", joined))):
        del where[m.start() : m.end()]
        joined = joined[: m.start()] + joined[m.end() :]
    return joined, where


def find_spans(text: str, needle: str) -> list[tuple[int, int]]:
    """Spans of the needle in the original text, compared after normalisation."""
    hay, where = normalised_with_map(text)
    want = normalised_with_map(needle)[0].strip()
    out, at = [], hay.find(want) if want else -1
    while at >= 0:
        out.append((where[at], where[at + len(want) - 1] + 1))
        at = hay.find(want, at + len(want))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


@F.pandas_udf(SPANS)
def spans_of(text: pd.Series, needle: pd.Series) -> pd.Series:
    return pd.Series([[{"start": a, "end": b} for a, b in find_spans(t or "", n or "")] for t, n in zip(text, needle)])


def chunk_spans(starts: list[int], length: int, max_chars: int, overlap: int):
    """(from, to) of overlapping windows over a text whose words start at ``starts``.

    A window gives way to the last word start in reach, if that leaves it over
    half its size; the next one goes back by the overlap, and at least one
    character on.
    """
    begin, end = 0, 0
    while end < length:
        end = min(begin + max_chars, length)
        if end < length:
            word = starts[bisect_right(starts, end) - 1]
            end = word if word - begin > max_chars // 2 + 1 else end
        yield begin, end
        begin = max(begin + 1, end - overlap)


def chunk(text: str | None, max_chars: int, overlap: int) -> list[str]:
    """The text, its white space made single blanks, in overlapping windows that end at words where they can."""
    if not 0 <= overlap < max_chars:
        raise ValueError("need max_chars > overlap >= 0")
    words = (text or "").split()
    whole, starts = " ".join(words), [0, *accumulate(len(w) + 1 for w in words[:-1])]
    return [part for a, z in chunk_spans(starts, len(whole), max_chars, overlap) if (part := whole[a:z].strip())]


def chunks(max_chars: int = 900, overlap: int = 120) -> Callable[[Column], Column]:
    chunk("", max_chars, overlap)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def made(text: pd.Series) -> pd.Series:
        return text.map(lambda t: chunk(t, max_chars, overlap))

    return made


def diff_lines(a: str | None, b: str | None, context: int = 3, most: int = 200) -> tuple[list[str], bool]:
    lines = list(difflib.unified_diff((a or "").splitlines(), (b or "").splitlines(), "from", "to", n=context, lineterm=""))
    return lines[:most], len(lines) > most


DIFF = T.StructType([T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("truncated", T.BooleanType())])


def unified_diff(context: int = 3, most: int = 200) -> Callable[[Column, Column], Column]:
    @F.pandas_udf(DIFF)
    def made(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [diff_lines(x, y, context, most) for x, y in zip(a, b)]
        return pd.DataFrame({"lines": [r[0] for r in rows], "truncated": [r[1] for r in rows]})

    return made


def _ratio(a: str, b: str) -> float:
    return 1.0 if a == b else difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of two texts, with no shortcut for frequent characters; a null (a pair that needs none) has none."""
    return pd.Series([None if x is None or y is None else _ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays taken as sets; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
