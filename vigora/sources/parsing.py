"""Parsers of legal text: blocks, node types, citations, clauses, serial lists, rate tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- structure ----------------------------------------------------------------


def blocks(text: str) -> list[tuple[int, int, str]]:
    """(start, end, text) of paragraphs: parted by empty lines, or by lines where there are none."""
    mark = r"\n\s*\n" if re.search(r"\n\s*\n", text) else r"\n"
    out, at = [], 0
    for m in [*re.finditer(mark, text), None]:
        end = m.start() if m else len(text)
        part = text[at:end]
        if part.strip():
            a = at + len(part) - len(part.lstrip())
            out.append((a, a + len(part.strip()), part.strip()))
        at = m.end() if m else end
    return out


def node_type(block: Column) -> Column:
    """What a paragraph is, by how it begins; the first test that holds."""
    starts = lambda p: block.rlike(p)
    return (
        F.when(starts(r"(?i)^chapter\s+[ivxlc\d]+"), "chapter").when(starts(r"(?i)^(part|schedule|annexure|appendix)\b"), "schedule")
        .when(starts(r"(?i)^form\s+[A-Z]+[- ]?\d"), "form").when(starts(r"^\d+[A-Z]*\.\s"), "section").when(starts(r"^\(\d+[A-Z]*\)\s"), "subsection")
        .when(starts(r"^\([ivx]+\)\s"), "subclause").when(starts(r"^\([a-z]{1,2}\)\s"), "clause").when(starts(r"(?i)^provided\b"), "proviso").when(starts(r"(?i)^explanation\b"), "explanation").otherwise("paragraph")
    )


CITATION = re.compile(r"(?i)\b(?P<kind>section|sub-section|rule|sub-rule|form|article)s?\s+(?P<label>[A-Z]{2,5}[ -]?\d[\w-]*|\d+[A-Z]*(?:\s*\([0-9a-z]+\))*)")
ACT = re.compile(r"\b((?:[A-Z][\w’'-]*\s+(?:and\s+|of\s+|the\s+)*){1,8}(?:Act|Rules),?\s+\d{4})")


def citations(text: str, reach: int = 220) -> list[dict]:
    """Cited provisions with their places, and the nearest work named within ``reach`` characters."""
    works = [(m.start(), " ".join(m[1].split())) for m in ACT.finditer(text)]
    out = []
    for m in CITATION.finditer(text):
        near = min(((abs(at - m.end()), name) for at, name in works if abs(at - m.end()) <= reach), default=(0, None))
        out.append({"kind": m["kind"].lower(), "label": re.sub(r"\s+", "", m["label"]), "work": near[1], "start": m.start(), "end": m.end()})
    return out


STRUCTURE = "key string, pos int, start int, end int, node_type string, owner int, text string, text_hash string"


def structure(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Paragraphs with types, hashes, and the section or rule that each continues (its place; its own for a section)."""
    from pyspark.sql import Window

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(str(k), n, a, b, t) for k, x in zip(pdf["key"], pdf["text"]) for n, (a, b, t) in enumerate(blocks(x or ""))], columns=["key", "pos", "start", "end", "text"])

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(run, "key string, pos int, start int, end int, text string")
    rows = rows.withColumn("node_type", node_type(F.col("text")))
    owner = F.last(F.when(F.col("node_type").isin("section", "chapter", "schedule", "form"), F.col("pos")), ignorenulls=True).over(Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("owner", owner).withColumn("text_hash", F.sha2("text", 256))


def references(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(str(k), c["kind"], c["label"], c["work"], c["start"], c["end"]) for k, x in zip(pdf["key"], pdf["text"]) for c in citations(x or "")], columns=["key", "kind", "label", "work", "start", "end"])

    return docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(run, "key string, kind string, label string, work string, start int, end int")


# --- amendment clauses ----------------------------------------------------------

QUOTED = r"[\"“‘']([^\"”’']+)[\"”’']"
#: Ordered patterns of an amending clause; the first that fits is taken.
PATTERNS = [
    ("SUBSTITUTE", re.compile(rf"(?is)for\s+the\s+(?:words?|figures?|letters?)[^\"“‘']*{QUOTED}.*?(?:words?|figures?|letters?)?[^\"“‘']*{QUOTED}\s+shall\s+be\s+substituted")),
    ("SPLICE", re.compile(rf"(?is)(?P<side>after|before)\s+the\s+(?:words?|figures?|letters?)[^\"“‘']*{QUOTED}.*?{QUOTED}\s+shall\s+be\s+inserted")),
    ("OMIT", re.compile(rf"(?is)the\s+(?:words?|figures?|letters?)[^\"“‘']*{QUOTED}\s+shall\s+be\s+omitted")),
    ("OMIT", re.compile(r"(?is)shall\s+(?:be\s+omitted|stand\s+omitted)")),
    ("INSERT_SIBLING", re.compile(r"(?is)after\s+(?:rule|section|sub-rule|sub-section)\s+(?P<anchor>\(?[0-9A-Za-z]+\)?).*?following\s+(?:rule|section|sub-rule|sub-section)s?\s+shall\s+be\s+inserted[^:]*:\s*[-–—]*\s*(?P<body>.+)")),
    ("SUBSTITUTE", re.compile(r"(?is)following\s+(?:rule|section|sub-rule|sub-section)s?\s+shall\s+be\s+substituted[^:]*:\s*[-–—]*\s*(?P<body>.+)")),
    ("CORRIGENDUM", re.compile(rf"(?is)for\s+{QUOTED}\s*,?\s*read\s+{QUOTED}")),
    ("RESCIND", re.compile(r"(?is)\bhereby\s+rescinds?\b")),
    ("COMMENCE", re.compile(r"(?is)shall\s+(?:come\s+into\s+force|be\s+deemed\s+to\s+have\s+come\s+into\s+force)")),
]
TARGET = re.compile(r"(?i)\bin\s+(?P<kind>rule|section)\s+(?P<label>\d+[A-Z]*)(?:\s*,?\s*in\s+sub-(?:rule|section)\s+\((?P<sub>[0-9A-Za-z]+)\))?|\b(?P<kind2>rule|section)\s+(?P<label2>\d+[A-Z]*)\b")


def compile_clause(clause: str, work: str) -> dict:
    """One clause as an event: operation, target, old and new text, reasons for review."""
    event = {"operation": "UNKNOWN", "component_id": None, "anchor_id": None, "old_text": None, "new_text": None, "before": False, "everywhere": bool(re.search(r"(?i)at both (?:the )?places|wherever they occur|at all (?:the )?places", clause))}
    kind = "rule"
    if (t := TARGET.search(clause)) is not None:
        kind, label = (t["kind"] or t["kind2"]).lower(), t["label"] or t["label2"]
        event["component_id"] = f"{work}/{kind}/{label}" + (f"/sub{kind}/{t['sub']}" if t["sub"] else "")
    for operation, pattern in PATTERNS:
        if (m := pattern.search(clause)) is None:
            continue
        event["operation"], groups = operation, m.groupdict()
        plain = [g for n, g in enumerate(m.groups(), 1) if n not in pattern.groupindex.values()]
        if operation in ("SUBSTITUTE", "CORRIGENDUM") and len(plain) == 2:
            event["old_text"], event["new_text"] = plain
        elif operation == "SPLICE":
            event["old_text"], event["new_text"] = plain
            event["before"] = groups["side"].lower() == "before"
        elif operation == "OMIT" and plain:
            event["old_text"] = plain[0]
        if groups.get("body"):
            event["new_text"] = groups["body"].strip(" \n\t\"“”'")
        if groups.get("anchor"):
            event["anchor_id"] = f"{work}/{kind}/{groups['anchor'].strip('()')}"
            if (own := re.match(r"(\d+[A-Z]*)", event["new_text"] or "")) is not None:
                event["component_id"] = f"{work}/{kind}/{own[1]}"
        break
    reasons = [r for r, bad in (("unknown_operation", event["operation"] == "UNKNOWN"), ("target_missing", event["component_id"] is None), ("insert_without_text", event["operation"].startswith("INSERT") and not event["new_text"]), ("anchor_missing", event["operation"].startswith("INSERT") and not event["anchor_id"])) if bad]
    return event | {"review_reasons": reasons, "status": "needs_review" if reasons else "validated"}


EVENTS = "document_id string, seq int, event_id string, operation string, component_id string, anchor_id string, old_text string, new_text string, before boolean, everywhere boolean, status string, review_reasons array<string>, start int, end int, excerpt string"


def compile_events(sources: DataFrame, work: str) -> DataFrame:
    """Notifications (document_id, text) to events, a clause each; a clause begins with '(a)', '(ii)', '1.' or a new paragraph."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["document_id"], pdf["text"]):
                context = ""
                for seq, (a, b, part) in enumerate(blocks(text or "")):
                    if re.fullmatch(r"(?is).*\bin\s+(?:rule|section)\s+\d+[A-Z]*\s*,?\s*[-–—:]*", part):
                        context = part
                        continue
                    e = compile_clause(part if TARGET.search(part) else f"{context} {part}", work)
                    if e["operation"] == "UNKNOWN" and e["component_id"] is None and not re.search(r"(?i)substitut|insert|omit", part):
                        continue
                    digest = hashlib.sha256(part.encode()).hexdigest()
                    event_id = "evt_text_" + hashlib.sha256(f"{doc}|{a}|{b}|{digest}".encode()).hexdigest()[:16]
                    rows.append((doc, seq, event_id, e["operation"], e["component_id"], e["anchor_id"], e["old_text"], e["new_text"], e["before"], e["everywhere"], e["status"], e["review_reasons"], a, b, part[:400]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in re.split(r", (?=\w+ )", EVENTS)])

    return sources.select("document_id", "text").mapInPandas(run, EVENTS)


# --- serials and rate tables ------------------------------------------------------


def serial_list(text: str) -> list[str]:
    """'3, 4 and 26A to 26L' as its serials."""
    out = []
    for m in re.finditer(r"(\d+)([A-Z]*)(?:\s+to\s+(\d+)([A-Z]*))?", text):
        a, x, b, y = m.groups()
        if b is None:
            out.append(a + x)
        elif a == b and len(x) == len(y) == 1:
            out += [a + chr(c) for c in range(ord(x), ord(y) + 1)]
        elif not x and not y and int(a) <= int(b):
            out += [str(k) for k in range(int(a), int(b) + 1)]
        else:
            out += [a + x, b + y]
    return list(dict.fromkeys(out))


def rate_table(lines: list[str]) -> list[dict]:
    """Lines of a schedule table to entries, by states: a heading with a rate opens a schedule, a serial opens an entry, codes are its tariff item, all else its description."""
    schedule, rate, entries, state = "I", None, [], "heading"
    for line in (x.strip() for x in lines):
        if not line:
            continue
        if (m := re.match(r"(?i)schedule\s+([IVXLC]+)\b(?:.*?(\d+(?:\.\d+)?)\s*(?:%|per cent))?", line)) is not None:
            schedule, rate, state = m[1].upper(), float(m[2]) if m[2] else rate, "serial"
        elif (m := re.fullmatch(r"(\d+[A-Z]*)\.?(?:\s+([\d, ]{2,}))?(?:\s+(\D.*))?", line)) is not None and (state != "tariff" or m[2] or m[3]) and not re.fullmatch(r"\d{4,8}", line):
            entries.append({"schedule_id": schedule, "rate": rate, "pos": len(entries), "sno": m[1], "tariff_item": (m[2] or "").strip(" ,"), "description": (m[3] or "").strip(), "is_omitted": bool(re.search(r"(?i)omitted|\*\*\*", m[3] or ""))})
            state = "description" if m[2] else "tariff"
        elif entries and state == "tariff" and re.fullmatch(r"[\d, ]+", line):
            entries[-1]["tariff_item"], state = line.strip(" ,"), "description"
        elif entries:
            entries[-1]["description"] = (entries[-1]["description"] + " " + line).strip()
            state = "description"
    return entries


RATE_CLAUSES = [
    ("RATE_OMIT_ENTRIES", re.compile(r"(?i)(?:S\.\s*No\.?|serial numbers?)\s+(?P<sno>[\dA-Z, ]+(?:and|to)?[\dA-Z, ]*?)\s+(?:and the entries relating thereto\s*,?\s*)?shall be omitted")),
    ("RATE_SUBSTITUTE_WORDS", re.compile(rf"(?is)(?:S\.\s*No\.?|serial number)\s+(?P<sno>\d+[A-Z]*).*?for the (?:words?|figures?|entry)[^\"“]*{QUOTED}.*?{QUOTED}\s+shall be substituted")),
    ("RATE_OMIT_WORDS", re.compile(rf"(?is)(?:S\.\s*No\.?|serial number)\s+(?P<sno>\d+[A-Z]*).*?the words?[^\"“]*{QUOTED}\s+shall be omitted")),
    ("RATE_INSERT_WORDS", re.compile(rf"(?is)(?:S\.\s*No\.?|serial number)\s+(?P<sno>\d+[A-Z]*).*?after the words?[^\"“]*{QUOTED}.*?{QUOTED}\s+shall be inserted")),
    ("RATE_SUBSTITUTE_COLUMN", re.compile(rf"(?is)(?:S\.\s*No\.?|serial number)\s+(?P<sno>\d+[A-Z]*).*?in column \((?P<col>[234])\).*?{QUOTED}\s+shall be substituted")),
    ("RATE_INSERT_ENTRIES", re.compile(rf"(?is)after (?:S\.\s*No\.?|serial number)\s+(?P<after>\d+[A-Z]*).*?following.*?shall be inserted.*?[\"“]?(?P<sno>\d+[A-Z]*)\.?\s+(?P<code>[\d, ]{{2,}})\s+(?P<body>[^\"”]+)")),
]


def rate_clause(clause: str) -> dict:
    """One clause of a rate notification as an event; RATE_UNKNOWN if none of the patterns fits."""
    for operation, pattern in RATE_CLAUSES:
        if (m := pattern.search(clause)) is not None:
            g = m.groupdict()
            plain = [x for n, x in enumerate(m.groups(), 1) if n not in pattern.groupindex.values()]
            return {"operation": operation, "sno": "|".join(serial_list(g["sno"])), "col": g.get("col"), "tariff_item": (g.get("code") or "").strip(" ,") or None, "after_sno": g.get("after"), "old_value": plain[0] if len(plain) == 2 or operation == "RATE_OMIT_WORDS" else None, "new_value": (g.get("body") or (plain[-1] if plain and operation != "RATE_OMIT_WORDS" else "")).strip() or None}
    return {"operation": "RATE_UNKNOWN", "sno": None, "col": None, "tariff_item": None, "after_sno": None, "old_value": None, "new_value": None}


RATE_ENTRIES = "notification string, schedule_id string, rate double, pos int, sno string, tariff_item string, description string, is_omitted boolean"


def rate_tables(sources: DataFrame) -> DataFrame:
    """Notifications (notification, text) to schedule entries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{"notification": n} | e for n, t in zip(pdf["notification"], pdf["text"]) for e in rate_table((t or "").splitlines())]
            yield pd.DataFrame(rows, columns=["notification", "schedule_id", "rate", "pos", "sno", "tariff_item", "description", "is_omitted"])

    return sources.select("notification", "text").mapInPandas(run, RATE_ENTRIES)


def rate_events(sources: DataFrame) -> DataFrame:
    """Amending notifications (notification, target, effective, published, text) to rate events, a paragraph each."""
    schema = "notification string, schedule_id string, operation string, sno string, col string, old_value string, new_value string, tariff_item string, after_sno string, effective date, published date, seq long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                schedule = None
                for seq, (_, _, part) in enumerate(blocks(r.text or "")):
                    if (m := re.search(r"(?i)in schedule\s+([IVXLC]+)\b", part)) is not None:
                        schedule = m[1].upper()
                    e = rate_clause(part)
                    if e["operation"] != "RATE_UNKNOWN" or re.search(r"(?i)S\.\s*No|serial", part):
                        rows.append((r.target, schedule, e["operation"], e["sno"], e["col"], e["old_value"], e["new_value"], e["tariff_item"], e["after_sno"], r.effective, r.published, seq))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return sources.select("target", "effective", "published", "text").mapInPandas(run, schema)
