"""Replays: ordered, stateful folds of events over dated texts and rate schedules.

A fold needs its group's events in order and its own state, which no built-in
operator has; it runs as one Arrow-fed Python function for each group (a work,
a schedule), which Spark spreads over the cluster.
"""

from __future__ import annotations

import difflib
import re
from collections import OrderedDict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigora.functions.text import find_spans, insert_blanks

OMITTED = "[Omitted]"


class EditError(ValueError):
    """An edit whose text or anchor cannot be found, or not clearly."""


def replace_unique(text: str, old: str, new: str, occurrence: int | None = None, everywhere: bool = False, reflected: bool = False) -> str:
    """Replaces the only occurrence; a numbered one or all where that is said; else one found after normalisation."""
    if reflected and new and new in text:
        return text
    n = text.count(old) if old else 0
    if n == 1:
        return text.replace(old, new, 1)
    if n > 1:
        if occurrence and occurrence <= n:
            at = -1
            for _ in range(occurrence):
                at = text.find(old, at + 1)
            return text[:at] + new + text[at + len(old) :]
        if everywhere:
            return text.replace(old, new)
        raise EditError("several occurrences")
    spans = find_spans(text, old)
    if len(spans) == 1 or everywhere and spans:
        for a, b in reversed(spans):
            text = text[:a] + new + text[b:]
        return text
    raise EditError("not found")


def splice(text: str, anchor: str, insert: str, before: bool = False, reflected: bool = False) -> tuple[str, str | None]:
    """Inserts beside an anchor, with blanks where they are needed; (text, warning)."""
    if reflected and insert in text:
        return text, "already_reflected"
    n = text.count(anchor) if anchor else 0
    if n > 1:
        raise EditError("several anchors")
    if n == 1:
        a = text.find(anchor)
        b = a + len(anchor)
    else:
        spans = find_spans(text, anchor)
        if len(spans) != 1:
            raise EditError("anchor not found")
        a, b = spans[0]
    at = a if before else b
    head, tail = text[:at], text[at:]
    if tail.lstrip().startswith(insert.strip()):
        return text, "duplicate_insertion_skipped"
    return head + insert_blanks(head, insert, tail) + tail, None


def omit(text: str, part: str | None, everywhere: bool = False) -> str:
    """Without the part; with no part given, or nothing left, the whole is omitted."""
    if not part:
        return OMITTED
    made = re.sub(r"[ \t]{2,}", " ", replace_unique(text, part, "", everywhere=everywhere)).strip()
    return made or OMITTED


def parent(component: str) -> str | None:
    head, _, _ = component.rpartition("/")
    head, _, _ = head.rpartition("/")
    return head or None


# What stands before a number in brackets that begins no sub-rule, what follows one that does, and notes on history.
REFERS = re.compile(r"(?i)(?:sub-?\s*(?:rule|section)|section|clause|proviso|rule)\s*$")
QUOTES_HISTORY = re.compile(r"(?is)\b(?:Inserted|Substituted|Omitted|Amended)\b.{0,160}\bfor\s*:\s*[\"'`“‘―-]?\s*$")
MAY_END = re.compile(r"[\s.\]\):;,\-–—\"'“‘\[]$")
MAY_BEGIN = re.compile(r"(?i)\s*(?:[A-Z\[]|No\b|Where\b|The\b|Any\b|Every\b|Notwithstanding\b|For\b|Upon\b|In\b|A\b|An\b)")
HISTORY = re.compile(r"(?is)\s+\d+\s*(?:Inserted|Substituted|Omitted|Amended)\b.{0,220}\bfor\s*:")


def subrule_starts(text: str) -> list[tuple[str, int]]:
    """(label, place) of the numbers in brackets that begin a sub-rule; references and quoted history are none."""
    out = []
    for m in re.finditer(r"\((\d+[A-Za-z]?)\)", text):
        before = text[max(0, m.start() - 220) : m.start()]
        kept = before.rstrip()
        if (not kept or MAY_END.search(kept)) and MAY_BEGIN.match(text, m.end()) and not REFERS.search(before) and not QUOTES_HISTORY.search(before):
            out.append((m[1].upper(), m.start()))
    return out


def subrule_span(text: str, label: str) -> tuple[int, int] | None:
    """Where a sub-rule stands in its rule's text, up to the next one or a note on its history; None if it is not there exactly once."""
    starts = subrule_starts(text)
    mine = [k for k, (x, _) in enumerate(starts) if x == label.upper()]
    if not label or len(mine) != 1:
        return None
    begin = starts[mine[0]][1]
    end = starts[mine[0] + 1][1] if mine[0] + 1 < len(starts) else len(text)
    note = HISTORY.search(text, begin, end)
    return begin, (note.start() if note else end)


class TextState:
    """Dated versions of a work's components.

    A sub-rule that is no component yet, but stands in its rule's text, becomes
    one when an event first needs it; a text edit whose target is nowhere goes
    to the text of its parent. What a component becomes, its parent's text
    becomes too, where it holds the component's text once.
    """

    def __init__(self, base: dict[str, str], base_date):
        self.now = dict(base)
        self.base = dict(base)
        self.versions = [[c, t, base_date, None, None, []] for c, t in sorted(base.items())]
        self.last = {v[0]: v for v in self.versions}

    def put(self, component: str, text: str, date, event: str) -> None:
        chain = []
        if (old := self.last.get(component)) is not None:
            old[3] = date
            chain = old[5]
        row = [component, text, date, None, event, [*chain, event]]
        self.versions.append(row)
        self.last[component] = row
        self.now[component] = text

    def apply(self, e: dict) -> str:
        """Applies one event; 'applied', 'already_reflected', or an EditError with the reason."""
        op, target, old, new = e["operation"], e["component_id"], e["old_text"] or "", e["new_text"] or ""
        if op in ("INSERT_SIBLING", "INSERT_CHILD"):
            anchor = e["anchor_id"]
            if not anchor or not self.known(anchor):
                raise LookupError("anchor component missing")
            if target in self.now:
                if self.now[target] == new:
                    return "already_reflected"
                raise EditError("component exists")
            self.put(target, new, e["date"], e["event_id"])
            if op == "INSERT_CHILD":
                before = self.now[anchor]
                self.put(anchor, (before + "\n" + new).strip(), e["date"], e["event_id"])
                self.sync(anchor, before, e)
            return "applied"
        if not self.known(target):
            if old and op in ("SPLICE", "SUBSTITUTE", "OMIT") and (above := parent(target)) in self.now:
                return self.edit_parent(above, e)
            raise LookupError("target component missing")
        text = self.now[target]
        made = self.edited(target, e)
        if made is None:
            return "already_reflected"
        self.put(target, made, e["date"], e["event_id"])
        if text != made:
            self.sync(target, text, e)
        return "applied"

    def edited(self, component: str, e: dict) -> str | None:
        """The component's text after a text edit; None if it shows the edit already."""
        op, old, new, everywhere, text = e["operation"], e["old_text"] or "", e["new_text"] or "", bool(e["everywhere"]), self.now[component]
        try:
            if op == "SUBSTITUTE":
                return new if not old else replace_unique(text, old, new, e["occurrence"] if e["occurrence"] == e["occurrence"] else None, everywhere)
            if op == "SPLICE":
                made, warning = splice(text, old, new, bool(e["before"]))
                return None if warning else made
            if op == "OMIT":
                return omit(text, old or None, everywhere)
            if op == "CORRIGENDUM":
                return replace_unique(text, old, new, everywhere=everywhere)
        except EditError:
            if op == "SUBSTITUTE" and new and (new in text or new in self.base.get(component, "")) or op == "OMIT" and old and old not in text:
                return None
            raise
        raise EditError("unsupported operation")

    def known(self, component: str) -> bool:
        """Whether there is such a component; a sub-rule in its rule's text becomes one, without a version of its own so far."""
        if component not in self.now and "/subrule/" in component and (above := parent(component)) in self.now:
            if (span := subrule_span(self.now[above], component.rpartition("/")[2])) is not None:
                self.now[component] = self.now[above][slice(*span)].strip()
        return component in self.now

    def sync(self, component: str, before: str, e: dict) -> None:
        """The parent's text follows, where it holds the component's former text once."""
        above = parent(component)
        if above in self.now and before and self.now[above].count(before) == 1:
            whole = self.now[above]
            self.put(above, whole.replace(before, self.now[component], 1), e["date"], e["event_id"])
            self.sync(above, whole, e)

    def edit_parent(self, above: str, e: dict) -> str:
        """A text edit for a component that is nowhere, made in its parent's text; the component gets what the parent then has of it, else the new text."""
        before = self.now[above]
        made = self.edited(above, e)
        if made is None:
            return "already_reflected"
        self.put(above, made, e["date"], e["event_id"])
        span = subrule_span(made, e["component_id"].rpartition("/")[2])
        if own := (made[slice(*span)].strip() if span else (e["new_text"] or "").strip()):
            self.put(e["component_id"], own, e["date"], e["event_id"])
        self.sync(above, before, e)
        return "applied"


TEXT_OUT = "work_id string, component_id string, text string, valid_from date, valid_to date, created_by_event_id string, event_chain array<string>, outcome string, reason string"


def replay_text(base: DataFrame, events: DataFrame) -> DataFrame:
    """Folds ordered events over a work's baseline. Rows: versions (outcome 'version') and one row an event that did not apply ('already_reflected', 'gap').

    base: work_id, component_id, text, base_date. events: work_id, event_id,
    component_id, anchor_id, operation, old_text, new_text, occurrence,
    everywhere, before, date, seq. Events whose component is not there yet are
    tried again until a pass changes nothing.
    """

    def fold(key, b: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        work = key[0]
        state = TextState(dict(zip(b["component_id"], b["text"])), b["base_date"].iloc[0] if len(b) else None)
        todo = e.sort_values(["date", "seq"], kind="stable").where(lambda x: x.notna(), None).to_dict("records")
        done, progress = [], True
        while todo and progress:
            progress, left = False, []
            for x in todo:
                try:
                    result = state.apply(x)
                except LookupError as error:
                    left.append((x, str(error)))
                    continue
                except EditError as error:
                    result = f"gap:{error}"
                progress = True
                if result != "applied":
                    done.append((x, result.partition(":")[0], result.partition(":")[2] or None))
            todo, reasons = [x for x, _ in left], [r for _, r in left]
        done += [(x, "gap", f"target_not_in_store: {r}") for x, r in zip(todo, reasons if todo else [])]
        rows = [(work, c, t, a, z, ev, chain, "version", None) for c, t, a, z, ev, chain in state.versions]
        rows += [(work, x["component_id"], None, x["date"], None, x["event_id"], [], kind, reason) for x, kind, reason in done]
        return pd.DataFrame(rows, columns=["work_id", "component_id", "text", "valid_from", "valid_to", "created_by_event_id", "event_chain", "outcome", "reason"])

    return base.groupBy("work_id").cogroup(events.groupBy("work_id")).applyInPandas(fold, TEXT_OUT)


# --- rate schedules ---------------------------------------------------------

FUZZY = 0.70


def fuzzy_span(text: str, target: str, threshold: float = FUZZY) -> tuple[int, int] | None:
    """The best window like the target, if it is like it enough."""
    n, best = len(target), (threshold, None)
    if not n or not text:
        return None
    width, step = min(len(text), int(1.3 * n) + 1), max(1, n // 3)
    for at in range(0, max(1, len(text) - n + step), step):
        part = text[at : at + width]
        ratio = difflib.SequenceMatcher(None, part, target, autojunk=False).ratio()
        if ratio >= best[0]:
            best = (ratio, (at, at + len(part)))
    return best[1]


def serial_key(sno: str) -> tuple[int, str]:
    m = re.match(r"\s*(\d+)\s*(.*)", sno or "")
    return (int(m[1]), m[2].upper()) if m else (1 << 30, sno or "")


class RateState:
    """Entries of one notification's schedules, in order."""

    def __init__(self, entries: list[dict]):
        self.schedules: OrderedDict[str, list[dict]] = OrderedDict()
        for e in entries:
            self.schedules.setdefault(e["schedule_id"], []).append(dict(e))

    def find(self, schedule: str | None, sno: str) -> tuple[list[dict], int] | None:
        wanted = [schedule] if schedule in self.schedules else []
        for s in [*wanted, *(x for x in self.schedules if x not in wanted)]:
            for k, e in enumerate(self.schedules[s]):
                if e["sno"].strip().upper() == (sno or "").strip().upper():
                    return self.schedules[s], k
        return None

    def schedule(self, name: str | None) -> list[dict] | None:
        if name in self.schedules:
            return self.schedules[name]
        return next(iter(self.schedules.values())) if len(self.schedules) == 1 else None

    def words(self, entry: dict, old: str, new: str) -> bool:
        text = entry["description"]
        if old and old in text:
            entry["description"] = re.sub(r"\s{2,}", " ", text.replace(old, new, 1)).strip()
            return True
        if (span := fuzzy_span(text, old)) is not None:
            entry["description"] = re.sub(r"\s{2,}", " ", text[: span[0]] + new + text[span[1] :]).strip()
            return True
        return False

    def apply(self, e: dict, relaxed: bool = False) -> bool:
        """Whether the event had an effect."""
        op, snos = e["operation"], [s for s in (e["sno"] or "").split("|") if s]
        handler = getattr(self, "op_" + op.removeprefix("RATE_").lower(), None)
        return bool(handler and handler(e, snos, relaxed))

    def op_omit_entries(self, e, snos, relaxed):
        hits = [h for s in snos if (h := self.find(e["schedule_id"], s))]
        for rows, k in hits:
            rows[k]["is_omitted"] = True
        return bool(hits)

    def op_insert_entries(self, e, snos, relaxed):
        rows = self.schedule(e["schedule_id"])
        if rows is None:
            return False
        entry = {"schedule_id": rows[0]["schedule_id"] if rows else e["schedule_id"], "sno": snos[0] if snos else "", "tariff_item": e["tariff_item"] or "", "description": e["new_value"] or "", "is_omitted": False}
        anchor = e["after_sno"]
        place = next((k + 1 for k, x in enumerate(rows) if anchor and x["sno"] == anchor), None)
        if place is None and anchor and relaxed:
            number = serial_key(anchor)[0]
            place = next((k + 1 for back in range(1, 20) for k, x in reversed(list(enumerate(rows))) if serial_key(x["sno"])[0] == number - back), None)
        if place is None and anchor and not relaxed:
            return False
        if place is None:
            place = next((k for k, x in enumerate(rows) if serial_key(x["sno"]) > serial_key(entry["sno"])), len(rows))
        rows.insert(place, entry)
        return True

    def op_substitute_column(self, e, snos, relaxed):
        hit = self.find(e["schedule_id"], snos[0]) if snos else None
        if hit is None or not e["new_value"]:
            return False
        hit[0][hit[1]][{"2": "tariff_item", "3": "description", "4": "rate"}.get(str(e["col"] or 3), "description")] = e["new_value"]
        return True

    def op_substitute_item(self, e, snos, relaxed):
        hit = self.find(e["schedule_id"], snos[0]) if snos else None
        if hit is None or not e["old_value"]:
            return False
        entry = hit[0][hit[1]]
        made = re.sub(rf"\({re.escape(e['old_value'])}\)[^()]*", f"({e['old_value']}) {e['new_value'] or ''} ", entry["description"], count=1)
        changed = made != entry["description"]
        entry["description"] = made.strip()
        return changed

    def op_substitute_row(self, e, snos, relaxed):
        hit = self.find(e["schedule_id"], snos[0]) if snos else None
        if hit is None:
            return False
        hit[0][hit[1]] |= {"tariff_item": e["tariff_item"] or hit[0][hit[1]]["tariff_item"], "description": e["new_value"] or "", "is_omitted": False}
        return True

    def op_insert_words(self, e, snos, relaxed):
        hit = self.find(e["schedule_id"], snos[0]) if snos else None
        return hit is not None and bool(e["old_value"]) and self.words(hit[0][hit[1]], e["old_value"], f"{e['old_value']} {e['new_value']}")

    def op_omit_words(self, e, snos, relaxed):
        hit = self.find(e["schedule_id"], snos[0]) if snos else None
        return hit is not None and self.words(hit[0][hit[1]], e["old_value"] or "", "")

    def op_substitute_words(self, e, snos, relaxed):
        hit = self.find(e["schedule_id"], snos[0]) if snos else None
        return hit is not None and self.words(hit[0][hit[1]], e["old_value"] or "", e["new_value"] or "")

    def op_batch_substitute_words(self, e, snos, relaxed):
        entries = [h[0][h[1]] for s in snos if (h := self.find(e["schedule_id"], s))] if snos else [x for rows in self.schedules.values() for x in rows]
        return any([e["old_value"] in x["description"] and self.words(x, e["old_value"], e["new_value"] or "") for x in entries])

    def op_renumber(self, e, snos, relaxed):
        hit = self.find(e["schedule_id"], snos[0]) if snos else None
        if hit is None or not e["new_value"]:
            return False
        hit[0][hit[1]]["sno"] = e["new_value"]
        return True

    def op_substitute_portion(self, e, snos, relaxed):
        hit = self.find(e["schedule_id"], snos[0]) if snos else None
        if hit is None:
            return False
        begin, _, end = (e["old_value"] or "").partition("|")
        entry = hit[0][hit[1]]
        a = entry["description"].find(begin)
        z = entry["description"].find(end, a + len(begin)) if a >= 0 else -1
        if a < 0 or z < 0:
            return False
        entry["description"] = entry["description"][:a] + (e["new_value"] or "") + entry["description"][z + len(end) :]
        return True

    def op_amend_opening(self, e, snos, relaxed):
        return True

    op_supersede = op_amend_opening


RATE_OUT = "notification string, schedule_id string, pos int, sno string, tariff_item string, description string, rate string, is_omitted boolean, n_applied int, n_failed int"


def replay_rates(base: DataFrame, events: DataFrame, at: str | None = None) -> DataFrame:
    """Folds rate events over a notification's schedules, in order of date; a snapshot.

    base: notification, schedule_id, pos, sno, tariff_item, description,
    is_omitted, rate (optional). events: notification, schedule_id, operation, sno ('|' between
    several), col, old_value, new_value, tariff_item, after_sno, effective,
    published, seq. Events without effect are tried again after the others,
    inserts last and beside the nearest smaller serial.
    """
    if at is not None:
        events = events.where(F.col("effective") <= F.lit(at).cast("date"))
    base = base.withColumn("rate", F.col("rate").cast("string") if "rate" in base.columns else F.lit(None).cast("string"))

    def fold(key, b: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        state = RateState(b.sort_values(["schedule_id", "pos"], kind="stable")[["schedule_id", "sno", "tariff_item", "description", "rate", "is_omitted"]].to_dict("records"))
        ordered = e.sort_values(["effective", "published", "seq"], kind="stable").where(lambda x: x.notna(), None).to_dict("records")
        # Inserts that follow each other from one source go in the order of their serials.
        rows, run = [], []
        for x in [*ordered, None]:
            if x is not None and x["operation"] == "RATE_INSERT_ENTRIES" and (not run or (run[-1]["schedule_id"], run[-1]["effective"]) == (x["schedule_id"], x["effective"])):
                run.append(x)
                continue
            rows += sorted(run, key=lambda y: serial_key(y["sno"]))
            run = []
            if x is not None:
                (run if x["operation"] == "RATE_INSERT_ENTRIES" else rows).append(x)
        failed = [x for x in rows if not state.apply(x)]
        failed = [x for x in sorted(failed, key=lambda y: (y["operation"] == "RATE_INSERT_ENTRIES", serial_key(y["sno"]) if y["operation"] == "RATE_INSERT_ENTRIES" else (0, ""))) if not state.apply(x)]
        failed = [x for x in failed if x["operation"] != "RATE_INSERT_ENTRIES" or not state.apply(x, relaxed=True)]
        out = [(key[0], s, k, x["sno"], x["tariff_item"], x["description"], x.get("rate"), bool(x["is_omitted"]), len(rows) - len(failed), len(failed)) for s, entries in state.schedules.items() for k, x in enumerate(entries)]
        return pd.DataFrame(out, columns=["notification", "schedule_id", "pos", "sno", "tariff_item", "description", "rate", "is_omitted", "n_applied", "n_failed"])

    return base.groupBy("notification").cogroup(events.groupBy("notification")).applyInPandas(fold, RATE_OUT)
