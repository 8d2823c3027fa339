"""Parsers, baselines and rendering on hand-made texts."""

from __future__ import annotations

import datetime as dt
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from vigora.operators import baseline, replay
from vigora.sources import parsing, render

NOTICE = """In exercise of its powers the Government makes the following rules.

In the said rules, in rule 8, for the words “old words”, the words “new words” shall be substituted.

In rule 9, after the words “first part”, the words “and more” shall be inserted.

After rule 9, the following rule shall be inserted, namely: - “9A. A new rule.”

Rule 12 shall be omitted.

In rule 7 something odd happens to a section."""


def test_blocks_and_citations():
    made = parsing.blocks("a\nb\n\n  c  \n")
    assert [t for _, _, t in made] == ["a\nb", "c"] and [t for _, _, t in parsing.blocks("a\nb")] == ["a", "b"]
    text = "See section 16(2) of the Central Goods Act, 2017 and rule 36 of the Central Goods Rules, 2017."
    found = parsing.citations(text)
    assert [(c["kind"], c["label"]) for c in found] == [("section", "16(2)"), ("rule", "36")] and all(text[c["start"] : c["end"]].lower().startswith(c["kind"]) for c in found)
    assert found[0]["work"].endswith("Act, 2017")


def test_events_from_text_replay_onto_a_baseline(spark):
    events = parsing.compile_events(spark.createDataFrame([("n1", NOTICE)], "document_id string, text string"), "/w")
    made = {(r.operation, r.component_id): r for r in events.collect()}
    assert set(made) == {("SUBSTITUTE", "/w/rule/8"), ("SPLICE", "/w/rule/9"), ("INSERT_SIBLING", "/w/rule/9A"), ("OMIT", "/w/rule/12"), ("UNKNOWN", "/w/rule/7")}
    assert made["SUBSTITUTE", "/w/rule/8"].old_text == "old words" and made["UNKNOWN", "/w/rule/7"].review_reasons == ["unknown_operation"]
    assert all(NOTICE[r.start : r.end].startswith(r.excerpt[:20]) for r in made.values())
    base = spark.createDataFrame([("/w", f"/w/rule/{k}", t, dt.date(2017, 7, 1)) for k, t in ((8, "the old words here"), (9, "the first part only"), (12, "gone"))], "work_id string, component_id string, text string, base_date date")
    ready = events.where("status = 'validated'").select(F.lit("/w").alias("work_id"), "event_id", "component_id", "anchor_id", "operation", "old_text", "new_text", F.lit(None).cast("double").alias("occurrence"), "everywhere", "before", F.to_date(F.lit("2020-01-01")).alias("date"), F.col("seq").cast("long").alias("seq"))
    last = {r.component_id: r.text for r in replay.replay_text(base, ready).where("valid_to IS NULL AND outcome = 'version'").collect()}
    assert last == {"/w/rule/8": "the new words here", "/w/rule/9": "the first part and more only", "/w/rule/9A": "9A. A new rule.", "/w/rule/12": "[Omitted]"}


def test_structure_and_rendering(spark):
    docs = spark.createDataFrame([("d", "CHAPTER I\n\n1. Short title.\n\n(1) First & <last>.\n\nProvided that.\n\n2. Next.")], "k string, t string")
    nodes = parsing.structure(docs, "k", "t")
    made = nodes.orderBy("pos").collect()
    assert [r.node_type for r in made] == ["chapter", "section", "subsection", "proviso", "section"] and [r.owner for r in made] == [0, 1, 1, 1, 4]
    xml = render.documents(nodes, "key", "pos").first()
    root = ET.fromstring(xml.xml)
    assert [e.find("p").text for e in root] == [r.text for r in made] and root[2].get("sourceNodeType") == "subsection" and xml.path == "d.xml"
    assert parsing.references(docs, "k", "t").count() == 0


def test_serials_and_rate_tables(spark):
    assert len(parsing.serial_list("1 to 1500")) == 1500 and parsing.serial_list("9 to 3") == ["9", "3"]
    assert parsing.serial_list("3, 4 and 26A to 26D, 30 to 32") == ["3", "4", "26A", "26B", "26C", "26D", "30", "31", "32"]
    lines = ["Schedule I - 2.5%", "1. 0202, 0203 Meat of", "bovine animals", "2", "0303", "Fish", "2A. 0304 Omitted", "Schedule II - 6%", "1. 0405 Butter"]
    made = parsing.rate_tables(spark.createDataFrame([("n", "\n".join(lines))], "notification string, text string")).orderBy("pos").collect()
    assert [(r.schedule_id, r.rate, r.sno, r.tariff_item, r.description, r.is_omitted) for r in made] == [("I", 2.5, "1", "0202, 0203", "Meat of bovine animals", False), ("I", 2.5, "2", "0303", "Fish", False), ("I", 2.5, "2A", "0304", "Omitted", True), ("II", 6.0, "1", "0405", "Butter", False)]
    text = "In Schedule I, S. No. 3 and 4 shall be omitted.\n\nin Schedule II, against S. No. 5, for the words “dry”, the words “wet” shall be substituted.\n\nafter S. No. 6, the following shall be inserted, namely: “6A. 0707 Cucumbers”\n\nagainst S. No. 9 odd."
    day = dt.date(2020, 1, 1)
    events = parsing.rate_events(spark.createDataFrame([("a", "n", day, day, text)], "notification string, target string, effective date, published date, text string")).orderBy("seq").collect()
    assert [(e.operation, e.schedule_id, e.sno) for e in events] == [("RATE_OMIT_ENTRIES", "I", "3|4"), ("RATE_SUBSTITUTE_WORDS", "II", "5"), ("RATE_INSERT_ENTRIES", "II", "6A"), ("RATE_UNKNOWN", "II", None)]
    assert (events[1].old_value, events[1].new_value, events[2].after_sno, events[2].tariff_item) == ("dry", "wet", "6", "0707")


def test_baselines(spark):
    rows = spark.createDataFrame([("/w/rule/1", "1", "Text [Inserted by notification 3] stays"), ("/w/rule/2", "2", "x..........9"), ("/w/rule/3", "", "")], "component_id string, label string, text string")
    assert {r.component_id: r.f for r in rows.select("component_id", baseline.flags(F.col("text"), F.col("label")).alias("f")).collect()} == {"/w/rule/1": ["annotated"], "/w/rule/2": ["dot_leaders"], "/w/rule/3": ["empty", "no_label"]}
    clean = {r.component_id: (r.text, r.action) for r in baseline.cleaned(rows, F.col("label") == "").collect()}
    assert clean == {"/w/rule/1": ("Text stays", "cleaned"), "/w/rule/2": ("x..........9", "kept")}
    source = spark.createDataFrame([("/w/rule/2", "2", "good text"), ("/w/rule/1", "1", "")], "component_id string, label string, text string")
    made = {r.component_id: (r.repair, r.text) for r in baseline.repair(rows, source, F.lit(True)).collect()}
    assert made["/w/rule/2"] == ("repaired", "good text") and made["/w/rule/1"][0] == "replacement_rejected" and made["/w/rule/3"][0] == "unchanged"
    assert {r.component_id: r.block_reasons for r in baseline.tracks(rows, source).collect()} == {"/w/rule/1": ["tracks_disagree"], "/w/rule/2": ["tracks_disagree"], "/w/rule/3": ["second_track_missing"]}
    parents = spark.createDataFrame([("p", "head (1) one (2) two")], "component_id string, text string")
    children = spark.createDataFrame([("p", "p/2", "two", "TWO"), ("p", "p/1", "one", "two")], "parent_id string, component_id string, base_text string, now_text string")
    assert baseline.merged_children(parents, children).first().text == "head (1) TWO (2) two"
    events = spark.createDataFrame([("/w/rule/1/subrule/2",), ("/w/rule/10",), ("/w/rule/1",)], "t string")
    hit = {r.t: r.blocked_by for r in baseline.blocked_targets(events, spark.createDataFrame([("/w/rule/1",)], "component_id string"), "t").collect()}
    assert hit == {"/w/rule/1/subrule/2": "/w/rule/1", "/w/rule/10": None, "/w/rule/1": "/w/rule/1"}
