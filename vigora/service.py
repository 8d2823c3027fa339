"""Answers to single questions: a plan for the data, a small envelope on the driver."""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigora.functions.ids import overlaps
from vigora.operators import quality, temporal


def envelope(result: str, snapshot_id: str, **fields) -> dict:
    """result is ok, unresolved or error."""
    return {"result": result, "snapshot_id": snapshot_id, "retrieved_at": datetime.now(timezone.utc).isoformat(), "coverage_warning": None, "unresolved_gaps": [], "source_refs": []} | fields


def valid_date(value: str) -> bool:
    try:
        return bool(re.fullmatch(r"\d{4}-\d{2}-\d{2}", value or "") and date.fromisoformat(value))
    except ValueError:
        return False


#: Words before a number that say what is cited.
CITATION = re.compile(r"(?i)\b(section|sec\.?|s\.|rule|r\.|form)\s*([0-9]+[A-Z]*(?:\([0-9a-z]+\))*|[A-Z]+-[0-9A-Z-]+)")


class Service:
    """Questions over versions (component_id, work_id, valid_from, valid_to, text, text_sha256, created_by_event_id, event_chain), gaps (component_id, date, skip_reason), tiers (component_id, tier) and edges."""

    def __init__(self, versions: DataFrame, gaps: DataFrame | None = None, tiers: DataFrame | None = None, edges: DataFrame | None = None, snapshot_id: str = ""):
        self.versions, self.gaps, self.tiers, self.edges, self.snapshot_id = versions, gaps, tiers, edges, snapshot_id

    def exists(self, component: str) -> bool:
        return not self.versions.where(F.col("component_id") == component).limit(1).isEmpty()

    def resolve(self, citation: str, works: dict[str, str], limit: int = 10) -> list[str]:
        """Candidate ids of a citation; works: a phrase -> its work's id."""
        if citation.startswith("/"):
            return [citation]
        low, out = citation.lower(), []
        named = [w for phrase, w in works.items() if phrase.lower() in low] or list(works.values())
        for m in CITATION.finditer(citation):
            kind = {"s": "section", "r": "rule", "f": "form"}[m[1][0].lower()]
            label, *subs = re.findall(r"[0-9A-Za-z-]+", m[2])
            for work in named:
                if kind == "form":
                    out.append(f"/in/union/forms/{label.lower()}")
                else:
                    out.append(f"{work}/{kind}/{label}" + "".join(f"/sub{kind}/{s}" for s in subs))
        return list(dict.fromkeys(out))[:limit]

    def timeline(self, component: str) -> DataFrame:
        return self.versions.where(F.col("component_id") == component).orderBy("valid_from")

    def amendments(self, component: str) -> DataFrame:
        return self.timeline(component).where("created_by_event_id IS NOT NULL")

    def at(self, component: str, when: str) -> dict:
        """The text in force at a date, what is known to be missing, and a verdict."""
        if not valid_date(when):
            return envelope("error", self.snapshot_id, error="invalid_date")
        day = F.lit(when).cast("date")
        rows = self.versions.where(F.col("component_id") == component)
        found = temporal.as_of(rows, "component_id", day).select("*", (F.sha2("text", 256) == F.col("text_sha256")).alias("hash_ok"), quality.formatting_debt(F.col("text")).alias("debt")).first()
        if found is None:
            return envelope("unresolved", self.snapshot_id, status="partial_history" if self.exists(component) else "not_found", text="")
        gaps = [] if self.gaps is None else [r.skip_reason for r in self.gaps.where(overlaps(F.col("component_id"), F.lit(component)) & (F.col("date").isNull() | (F.col("date") <= day))).orderBy("skip_reason").limit(50).collect()]
        tier = None if self.tiers is None else self.tiers.where(F.col("component_id") == component).select("tier").first()
        tier = tier[0] if tier else "unknown"
        blocking = [n for n, ok in (("text_hash", found.hash_ok), ("coverage", not gaps), ("confidence", tier in ("A", "B", "unknown"))) if not ok]
        verdict = "ok_with_gaps" if blocking else "exact_with_formatting_debt" if found.debt else "exact"
        return envelope("ok", self.snapshot_id, status="ok", text=found.text, valid_from=str(found.valid_from), valid_to=str(found.valid_to) if found.valid_to else None, event_chain=list(found.event_chain or []), confidence_tier=tier, unresolved_gaps=gaps, verdict=verdict, blocking=blocking)

    def law(self, citation: str, works: dict[str, str], when: str) -> dict:
        """A citation and a date to a dated text; several that exist are ambiguous."""
        found = [c for c in self.resolve(citation, works) if self.exists(c)]
        if len(found) > 1:
            return envelope("unresolved", self.snapshot_id, status="ambiguous_citation", candidates=found)
        return self.at(found[0], when) if found else envelope("unresolved", self.snapshot_id, status="not_found", text="")

    def compare(self, component: str, low: str, high: str) -> dict:
        from vigora.functions.text import diff_lines

        rows = self.versions.where(F.col("component_id") == component)
        made = temporal.compare(rows, "component_id", F.lit(low).cast("date"), F.lit(high).cast("date"), "text").first()
        if made is None:
            return envelope("unresolved", self.snapshot_id, status="not_found")
        lines, truncated = diff_lines(made.from_value, made.to_value) if made.changed else ([], False)
        return envelope("ok", self.snapshot_id, status=made.status, text_changed=made.changed, unified_diff="\n".join(lines), truncated=truncated, n_events=made.n_events)

    def evidence(self, component: str, low: str, high: str) -> dict:
        """Everything about one component in a window."""
        day = lambda d: F.lit(d).cast("date")
        own = self.versions.where(overlaps(F.col("component_id"), F.lit(component)))
        rows = temporal.between(own, day(low), day(high)).orderBy("valid_from", "component_id").collect()
        before = temporal.last_known(own.where(F.col("component_id") == component), "component_id", day(low)).first()
        return envelope("ok", self.snapshot_id, component_id=component, preceding=before.asDict() if before else None, versions=[r.asDict() for r in rows], at_end=self.at(component, high), citation_ready=bool(before) and all(r.created_by_event_id for r in rows))
