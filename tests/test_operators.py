"""Operators on hand-checked cases."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vigora.functions import codes, ids, text
from vigora.operators import graph, ledger, quality, rates, replay, search, temporal
from vigora.service import Service, valid_date


def d(x):
    return dt.date.fromisoformat(x) if x else None


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


VERSIONS = [("r1", "2017-07-01", "2020-09-29", "a"), ("r1", "2020-09-29", None, "b"), ("r2", "2019-01-01", "2019-06-01", "c")]


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame([(k, d(a), d(b), t) for k, a, b, t in VERSIONS], "id string, valid_from date, valid_to date, text string")


@pytest.mark.parametrize(("day", "want"), [("2020-09-29", {"r1": "b"}), ("2020-09-28", {"r1": "a"}), ("2010-01-01", {}), ("2019-05-31", {"r1": "a", "r2": "c"}), ("2019-06-01", {"r1": "a"})])
def test_as_of(versions, day, want):
    assert {r.id: r.text for r in temporal.as_of(versions, "id", F.lit(day).cast("date")).collect()} == want


def test_as_of_or_last_has_every_key(versions):
    made = {r.id: (r.text, r.in_force) for r in temporal.as_of_or_last(versions, "id", F.lit("2021-01-01").cast("date")).collect()}
    assert made == {"r1": ("b", True), "r2": ("c", False)}


def test_intervals_and_chains(spark):
    events = spark.createDataFrame([("k", 1, 1), ("k", 2, 2), ("k", 5, 3)], "k string, at int, e int")
    made = temporal.intervals(temporal.chains(events, "k", "e", "at", "e"), "k", "at", "e").orderBy("seq").collect()
    assert [(r.valid_from, r.valid_to, r.event_chain, r.chain_length) for r in made] == [(1, 2, [1], 1), (2, 5, [1, 2], 2), (5, None, [1, 2, 3], 3)]


def test_compare_bounds(spark, versions):
    made = {r.id: r for r in temporal.compare(versions, "id", F.lit("2017-07-01").cast("date"), F.lit("2020-09-29").cast("date"), "text").collect()}
    assert (made["r1"].changed, made["r1"].n_events, made["r1"].status) == (True, 1, "ok")
    assert made["r2"].status == "partial_history"


def test_shrink_guard(spark):
    rows = [("k", 1, "x" * 600, "SUBSTITUTE"), ("k", 2, "short", "SUBSTITUTE"), ("k", 3, "short", "OMIT"), ("j", 1, "x" * 100, "SUBSTITUTE"), ("j", 2, "y", "SUBSTITUTE")]
    made = temporal.shrink_guard(spark.createDataFrame(rows, "k string, n int, t string, op string"), "k", "t", "op", "n").orderBy("k", "n").collect()
    assert [r.guarded for r in made] == [False, False, False, True, False] and made[3].t == "x" * 600


def test_ledger_merge_and_conflicts(spark):
    a = spark.createDataFrame([("e1", "needs_review"), ("e2", "validated"), (None, "validated")], "event_id string, status string")
    b = spark.createDataFrame([("e1", "validated"), ("e2", "validated")], "event_id string, status string")
    made = {r.event_id: (r.status, r.src_ord) for r in ledger.merge([a, b], "event_id", ledger.status_rank(F.col("status"))).collect()}
    assert made == {"e1": ("validated", 1), "e2": ("validated", 0)}
    rows = spark.createDataFrame([(1, "c", 1, "p", "d", True, True), (2, "c", 1, "q", "d", True, True), (3, "c", 2, "p", "d", True, True), (4, "c", 2, "q", "d", False, False)], "e int, c string, day int, p string, doc string, clean boolean, mat boolean")
    made = {r.e: r.conflict for r in ledger.conflicts(rows, "c", "day", "p", "doc", F.col("clean"), F.col("mat")).collect()}
    assert made == {1: True, 2: True, 3: False, 4: False}


def test_text_edits():
    assert replay.splice("under rule 9, he", "under rule 9,", "rule 9A and rule 14A,")[0] == "under rule 9, rule 9A and rule 14A, he"
    with pytest.raises(replay.EditError):
        replay.replace_unique("a x b x", "x", "y")
    assert replay.replace_unique("a x b x", "x", "y", everywhere=True) == "a y b y"
    assert replay.replace_unique("a x b x", "x", "y", occurrence=2) == "a x b y"
    assert replay.replace_unique("the “Act”  of\n2017", 'the "act" of 2017', "it") == "it"
    assert replay.omit("all of it", None) == replay.OMITTED and replay.omit("a b c", "b") == "a c"


def test_text_replay(spark):
    base = spark.createDataFrame([("w", "/w/rule/1", "old words stay", d("2017-07-01"))], "work_id string, component_id string, text string, base_date date")
    columns = "work_id string, event_id string, component_id string, anchor_id string, operation string, old_text string, new_text string, occurrence double, everywhere boolean, before boolean, date date, seq long"
    rows = [
        ("w", "e3", "/w/rule/2", None, "SUBSTITUTE", "fresh", "newer", None, False, False, d("2018-01-01"), 3), ("w", "e1", "/w/rule/1", None, "SUBSTITUTE", "old", "new", None, False, False, d("2018-01-01"), 1),
        ("w", "e2", "/w/rule/2", "/w/rule/1", "INSERT_SIBLING", None, "fresh text", None, False, False, d("2019-01-01"), 2), ("w", "e4", "/w/rule/1", None, "OMIT", "nowhere", None, None, False, False, d("2020-01-01"), 4),
        ("w", "e5", "/w/rule/9", None, "OMIT", None, None, None, False, False, d("2020-01-01"), 5), ("w", "e6", "/w/rule/1", None, "OMIT", None, None, None, False, False, d("2021-01-01"), 6),
    ]
    made = replay.replay_text(base, spark.createDataFrame(rows, columns)).collect()
    texts = [(r.component_id, r.text, len(r.event_chain)) for r in made if r.outcome == "version"]
    assert texts == [("/w/rule/1", "old words stay", 0), ("/w/rule/1", "new words stay", 1), ("/w/rule/2", "fresh text", 1), ("/w/rule/1", "[Omitted]", 2), ("/w/rule/2", "newer text", 2)]
    assert {(r.created_by_event_id, r.outcome) for r in made if r.outcome != "version"} == {("e4", "already_reflected"), ("e5", "gap")}
    assert [r.valid_to for r in made if r.outcome == "version"][0] == d("2018-01-01")


def test_rate_replay(spark):
    base = spark.createDataFrame([("n", "I", k, str(k + 1), "0101", f"goods number {k}", False) for k in range(3)], "notification string, schedule_id string, pos int, sno string, tariff_item string, description string, is_omitted boolean")
    columns = "notification string, schedule_id string, operation string, sno string, col string, old_value string, new_value string, tariff_item string, after_sno string, effective date, published date, seq long"
    e = lambda op, sno, old=None, new=None, after=None, day="2018-01-01", seq=0, col="3": ("n", "I", op, sno, col, old, new, "0202", after, d(day), d(day), seq)
    rows = [
        e("RATE_OMIT_ENTRIES", "1|9"), e("RATE_INSERT_ENTRIES", "2A", new="inserted", after="2", seq=1), e("RATE_SUBSTITUTE_WORDS", "2", "number", "item", seq=2), e("RATE_SUBSTITUTE_WORDS", "4", "wares", "things", seq=3),
        e("RATE_INSERT_ENTRIES", "4", new="some wares", after="3A", seq=4), e("RATE_RENUMBER", "3", new="3B", seq=5, day="2019-01-01"), e("RATE_UNKNOWN", "3", seq=6), e("RATE_SUBSTITUTE_COLUMN", "2", new="0303", col="2", seq=7),
    ]
    made = replay.replay_rates(base, spark.createDataFrame(rows, columns)).orderBy("pos").collect()
    assert [(r.sno, r.tariff_item, r.description, r.is_omitted) for r in made] == [("1", "0101", "goods number 0", True), ("2", "0303", "goods item 1", False), ("2A", "0202", "inserted", False), ("4", "0202", "some wares", False), ("3B", "0101", "goods number 2", False)]
    before = replay.replay_rates(base, spark.createDataFrame(rows, columns), at="2018-06-01").collect()
    assert "3" in {r.sno for r in before}


def test_codes(spark):
    row = spark.createDataFrame([("63 [other than 6305 32 00, 6309]", "0101 21 00, 0101 29", "Chapter 9; 2403 99 10 / 00]", "03 04")], "a string, b string, c string, d string")
    made = row.select(codes.code_list("a"), codes.code_list("b"), codes.typed_codes("c"), codes.digits("d")).first()
    assert made[0] == ["63"] and made[1] == ["01012100", "010129"] and [tuple(x) for x in made[2]] == [("chapter", "09"), ("hsn", "24039910")] and made[3] == "0304"
    assert one(spark, codes.breakdown(F.lit(2.5), F.lit(False))) == {"cgst": 2.5, "sgst": 2.5, "igst": 5.0} and one(spark, codes.breakdown(F.lit(2.5), F.lit(True))) == {"cess": 2.5}


def test_serials(spark):
    rows = spark.createDataFrame([("s", k, x) for k, x in enumerate(["1", "2", "2A", "4"])] + [("t", k, x) for k, x in enumerate(["1", "3", "2", "3"])], "g string, pos int, sno string").withColumn("om", F.lit(False))
    number = codes.leading_int("sno")
    assert [tuple(r) for r in rates.serial_gaps(rows, ["g"], number).collect()] == [("s", 3)]
    assert [(r.g, r.pos) for r in rates.serial_disorder(rows, ["g"], number, "pos", F.col("om")).collect()] == [("t", 2)]
    assert [(r.g, r.pos) for r in rates.duplicate_serials(rows, ["g"], codes.serial("sno"), "pos", F.col("om")).collect()] == [("t", 3)]


def test_chunks():
    t = "One sentence here. Another one; and more words follow on. " * 40
    made = text.chunk(t, 200, 40)
    assert all(len(c) <= 200 for c in made) and made[0].startswith("One") and made[-1].endswith("on.")
    assert text.chunk("short", 200, 40) == ["short"] and text.chunk("", 200, 40) == []
    for bad in ((0, 0), (10, 10), (10, -1)):
        with pytest.raises(ValueError):
            text.chunk("x", *bad)


def test_chunks_cover_the_text_and_end_at_words():
    r = random.Random(1)
    for _ in range(300):
        t = " ".join("x" * r.randint(1, 30) for _ in range(r.randint(0, 60)))
        most = r.randint(2, 80)
        overlap = r.randint(0, most - 1)
        at, made = 0, text.chunk(t, most, overlap)
        for c in made:
            assert len(c) <= most and t.find(c, max(0, at - overlap)) >= 0
            at = t.find(c, max(0, at - overlap)) + len(c)
        assert at == len(t)


def test_snippet_and_insert_blanks(spark):
    df = spark.createDataFrame([("a " * 60 + "second " + "b " * 100 + "first " + "c " * 100,), ("no hit " * 60,), ("short second",), (None,)], "t string")
    made = [r.s for r in df.select(text.snippet("t", ["first", "second"], size=60).alias("s")).collect()]
    assert "second" in made[0] and made[0].startswith("...") and made[0].endswith("...")
    assert made[1] == ("no hit " * 60)[:60] and made[2] == "short second" and made[3] is None
    phrase = df.select(text.snippet("t", ["second"], "first", 60).alias("s")).first().s
    assert "first" in phrase and "second" not in phrase
    cases = [("a", "b", "c", "a b c"), ("a ", "b", ", c", "a b, c"), ("(", "b", "}", "( b}"), ("", "b", "", "b"), ("a", "", "c", "ac"), ("a", " b ", "c", "a b c")]
    rows = spark.createDataFrame([c[:3] for c in cases], "x string, y string, z string")
    native = [r.m for r in rows.select(F.concat("x", text.prepared_insert(F.col("x"), F.col("y"), F.col("z")), "z").alias("m")).collect()]
    assert native == [c[3] for c in cases] == [x + text.insert_blanks(x, y, z) + z for x, y, z, _ in cases]


def test_passages_are_found_whatever_their_length(spark, monkeypatch):
    from vigora.operators import search

    docs = spark.createDataFrame([(1, "it says \"to be or not\" here"), (2, "a three word text of ten words in all here"), (3, None), (4, "nothing")], "doc_id long, text string")
    passages = spark.createDataFrame([("to be or not",), ("three word text",), ("",), (None,), ("absent",)], "p string")
    for size in (16_000_000, 10):
        monkeypatch.setattr(search, "PASSAGE_CHARS", size)
        assert sorted(r.doc_id for r in search.holding(docs, "doc_id", "text", passages, "p").collect()) == [1, 2]
    assert search.holding(docs, "doc_id", "text", passages.limit(0), "p").count() == 0


def test_ids_and_dates(spark):
    row = spark.createDataFrame([("/in/union/rules/r-2017/rule/08a/subrule/2", "1st day of July, 2017", "w.e.f. 31st October, 2025", "on 01.07.2017", "no date")], "i string, a string, b string, c string, e string")
    made = row.select(ids.work_of("i"), ids.parent_of("i"), ids.kind_of("i"), ids.normalised_component("i"), *[ids.legal_date(x) for x in "abce"]).first()
    assert made[:4] == ("/in/union/rules/r-2017", "/in/union/rules/r-2017/rule/08a", "rule", "/in/union/rules/r-2017/rule/8A/subrule/2")
    assert made[4:] == (d("2017-07-01"), d("2025-10-31"), d("2017-07-01"), None)
    assert one(spark, ids.relationship(F.lit("2 ways"))) == "REL_2_WAYS" and one(spark, ids.relationship(F.lit(""))) == "RELATED_TO"


def test_paths_and_resolution(spark):
    edges = spark.createDataFrame([("a", "b", "r"), ("b", "c", "r"), ("a", "c", "r"), ("c", "a", "r")], "source string, target string, type string")
    made = {(r.depth, r.node): "".join(r.path) for r in graph.paths(edges, F.lit("a"), 3).collect()}
    assert made == {(1, "b"): "ab", (1, "c"): "ac", (2, "c"): "abc", (2, "a"): "aca", (3, "a"): "abca", (3, "b"): "acab", (3, "c"): "acac"}
    two = spark.createDataFrame([("a", "b", "r"), ("a", "c", "r"), ("b", "t", "r"), ("c", "t", "r"), ("t", "z", "r")], "source string, target string, type string")
    found = sorted("".join(r.path) for r in graph.paths(two, F.lit("a"), 3).collect())
    assert found == ["ab", "abt", "abtz", "ac", "act"]
    known = spark.createDataFrame([("/in/union/acts/x-act-1990", True), ("/in/union/acts/x-act-1990/section/2", False)], "id string, is_document boolean")
    aliases = spark.createDataFrame([("/in/union/acts/the-x-act-1990", "/in/union/acts/x-act-1990")], "alias string, id string")
    refs = spark.createDataFrame([("/in/union/acts/the-x-act-1990/section/2",), ("/in/union/acts/the-x-act-1990/section/3",), ("/in/union/acts/x-act-1990/section/9",), ("/in/union/forms/f1",), ("http://x",), ("/in/union/acts/x-act-1990",), ("/in/union/acts/none",)], "t string")
    made = {r.t: r.status for r in graph.resolve(refs, "t", known, aliases, ids.document_of("t")).collect()}
    assert list(made[r.t] for r in refs.collect()) == ["resolved_by_alias", "alias_document_exists_child_missing", "document_exists_missing_child", "form_missing", "external_or_literal", "resolved", "document_missing"]


def test_tiers_and_spans(spark):
    t = lambda **k: one(spark, quality.tier(*(F.lit(k.get(n, v)) for n, v in (("blocked", False), ("portal", False), ("incomplete", False), ("result", "exact"), ("review", False), ("versions", True)))))
    assert (t(), t(blocked=True), t(review=True), t(result="true_substantive_mismatch"), t(result="none", versions=False)) == ("A", "D", "B", "C", "D")
    import hashlib

    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = spark.createDataFrame([("a", "hello world", [(0, 5, h("hello")), (4, 8, h("o wo")), (6, 11, h("nope")), (9, 99, "")])], "k string, t string, s array<struct<start: int, end: int, text_hash: string>>")
    assert {r.pos: r.errors for r in quality.span_errors(rows, "k", "t", "s").collect()} == {1: ["overlap"], 2: ["overlap", "hash_mismatch"], 3: ["out_of_bounds", "overlap", "hash_mismatch"]}


def test_search_scores(spark):
    docs = spark.createDataFrame([(1, "Road tax", "tax on roads and tax on cars"), (2, "Other", "nothing"), (3, "Cars", "road tax")], "id long, title string, body string")
    made = search.top_k(docs, search.lexical_score("road tax", F.col("body"), F.col("title"), F.col("id")), "id", 5).collect()
    assert [(r.id, r.score) for r in made] == [(1, 18), (3, 8)]


def test_service(spark):
    rows = [("/w", "/w/rule/1", d("2017-07-01"), d("2020-01-01"), "a", None, []), ("/w", "/w/rule/1", d("2020-01-01"), None, "b", "e1", ["e1"])]
    versions = spark.createDataFrame(rows, "work_id string, component_id string, valid_from date, valid_to date, text string, created_by_event_id string, event_chain array<string>").withColumn("text_sha256", F.sha2("text", 256))
    s = Service(versions, snapshot_id="s1")
    assert s.at("/w/rule/1", "2020-01-01")["text"] == "b" and s.at("/w/rule/1", "2019-12-31")["verdict"] == "exact"
    assert s.at("/w/rule/1", "2010-01-01")["status"] == "partial_history" and s.at("/w/rule/2", "2020-01-01")["status"] == "not_found" and s.at("/w/rule/1", "x")["result"] == "error"
    assert s.law("rule 1 of the W Rules", {"W Rules": "/w"}, "2021-01-01")["text"] == "b" and s.law("rule 7 of the W Rules", {"W Rules": "/w"}, "2021-01-01")["status"] == "not_found"
    made = s.compare("/w/rule/1", "2019-01-01", "2021-01-01")
    assert made["text_changed"] and "-a" in made["unified_diff"] and "+b" in made["unified_diff"] and made["n_events"] == 1
    assert s.amendments("/w/rule/1").count() == 1 and s.evidence("/w/rule/1", "2019-01-01", "2021-01-01")["citation_ready"]
    assert valid_date("2020-02-29") and not valid_date("2021-02-29")


def event(op, component, old=None, new=None, **more):
    return {"event_id": "e", "component_id": component, "anchor_id": None, "operation": op, "old_text": old, "new_text": new, "occurrence": None, "everywhere": False, "before": False, "date": d("2020-01-01")} | more


RULE = "(1) Every person shall apply. (2) The officer shall reply as in sub-rule (1) and in time. 3 Substituted on that day for: (2) The old. (3) No fee is due."


def test_subrules_in_a_rule_s_text():
    assert [x for x, _ in replay.subrule_starts(RULE)] == ["1", "2", "3"]
    assert RULE[slice(*replay.subrule_span(RULE, "2"))] == "(2) The officer shall reply as in sub-rule (1) and in time."
    assert replay.subrule_span(RULE, "4") is None and replay.subrule_span("(1) A. (1) The.", "1") is None


def test_events_on_subrules_that_only_their_rule_has():
    def state():
        return replay.TextState({"/r/rule/5": RULE}, d("2017-07-01"))

    s = state()
    assert s.apply(event("SUBSTITUTE", "/r/rule/5/subrule/1", "person", "firm")) == "applied"
    assert s.now["/r/rule/5/subrule/1"] == "(1) Every firm shall apply." and s.now["/r/rule/5"].startswith("(1) Every firm shall apply. (2)")
    s = state()
    assert s.apply(event("OMIT", "/r/rule/5/subrule/3")) == "applied"
    assert s.now["/r/rule/5"].endswith("The old. [Omitted]") and s.now["/r/rule/5/subrule/3"] == "[Omitted]"
    s = state()
    assert s.apply(event("SUBSTITUTE", "/r/rule/5/subrule/2", None, "(2) The office is silent.")) == "applied"
    assert "(2) The office is silent. 3 Substituted" in s.now["/r/rule/5"]
    s = state()
    assert s.apply(event("INSERT_CHILD", "/r/rule/5/subrule/3/proviso/1", None, "Provided that it may be.", anchor_id="/r/rule/5/subrule/3")) == "applied"
    assert s.now["/r/rule/5"].endswith("(3) No fee is due.\nProvided that it may be.")
    s = state()
    assert s.apply(event("SPLICE", "/r/rule/5/explanation/9", "No fee", "or tax")) == "applied"
    assert s.now["/r/rule/5"].endswith("(3) No fee or tax is due.") and s.now["/r/rule/5/explanation/9"] == "or tax"
    s = state()
    with pytest.raises(LookupError):
        s.apply(event("SUBSTITUTE", "/r/rule/5/subrule/9", None, "x"))
    with pytest.raises(LookupError):
        s.apply(event("OMIT", "/r/rule/6/subrule/1", "x"))
