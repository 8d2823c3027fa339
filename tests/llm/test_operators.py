"""Operators on small tables: brute force, and nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigora.llm import html, lm, mixing, neardup, neighbours, pieces, quality, quotes, tokens, toxicity
from vigora.llm.common import crc_mod, table
from vigora.llm.components import components

LONG = "word and another wörd " * 4000
ODD = [(1, "a b c", "s1"), (1, "a b c", "s1"), (2, None, None), (3, "", "s1"), (4, LONG, "s2"), (None, "no id here", "s2"), (5, "You idiot said it", "s3")]
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, score double, n long, copy int, weight double, rows string, label string, _h long, fp string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None, None, None, None, None, None, None) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark, [])


@pytest.fixture(scope="module")
def documents(spark, small):
    return table(spark, small, "documents").cache()


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=lambda x: (x is None, x))


ALL = sorted((r[0] for r in ODD), key=lambda x: (x is None, x))


def test_toxicity(spark, small, odd, none):
    labels = spark.createDataFrame([(k, 0, int(k % 2)) for k in range(400)] + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    texts = docs(spark, [(k, f"plain words {k} " + ("you twit again" if k % 2 else "good day"), "s") for k in range(400)])
    model = toxicity.fit(texts, labels)
    assert model.words or model.stems
    made = {r.doc_id: r.score for r in toxicity.score(texts, model).collect()}
    assert all((s >= toxicity.THRESHOLD) == bool(k % 2) for k, s in made.items())
    assert ids(toxicity.score(odd, model)) == ALL and toxicity.score(none, model).count() == 0
    bare = toxicity.fit(none, labels.limit(0))
    assert not bare.words and toxicity.score(odd, bare).where("score < 0 OR score > 1").count() == 0
    kept = toxicity.drop_toxic(texts, model)
    assert kept.columns == texts.columns and all(r.doc_id % 2 == 0 for r in kept.collect())


def test_toxicity_does_not_learn_from_held_out_rows(spark):
    rows = [(k, k % 2) for k in range(200)]
    kept = toxicity.sample(spark.createDataFrame(rows, "doc_id long, toxic int")).collect()
    assert {r.doc_id for r in kept} == {k for k, _ in rows if zlib.crc32(str(k).encode()) % 4 != 2}
    assert toxicity.sample(spark.createDataFrame(rows, "doc_id long, toxic int"), 10).count() == 10


def test_tokens_and_quality_keep_every_row(spark, odd, none):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    made = tokens.count_tokens(odd, path).collect()
    assert sorted((r.doc_id for r in made), key=lambda x: (x is None, x)) == ALL
    by = {r.doc_id: r for r in made}
    assert by[2].n_tokens == by[2].n_bytes == by[3].n_tokens == 0 and by[4].over_limit and by[4].n_bytes == len(LONG.encode())
    assert tokens.PrefixCounter(path).count(LONG[: by[4].fit_chars]) <= tokens.LIMIT < tokens.PrefixCounter(path).count(LONG[: by[4].fit_chars + 1])
    assert tokens.count_tokens(none, path).count() == 0
    judged = quality.judge_all(odd)
    assert ids(judged) == ALL and quality.judge_all(none).count() == 0
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and ids(kept) == sorted(r.doc_id for r in judged.where("kept").collect())


def test_pieces(spark, odd, none, documents):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    lattice = pieces.Lattice(path)
    for r in documents.join(pieces.encode_all(documents, path), "doc_id").limit(60).collect():
        best = lattice.encode(r.text, pieces.N_BEST)
        assert lattice.decode(r.ids) == r.text and r.round_trip and r.n_pieces == len(r.ids)
        assert [x.score for x in r.n_best] == pytest.approx([s for s, _ in best]) and r.ids == best[0][1] and not r.n_best[0].swaps
        words = lattice.cut(r.text)
        for x, (_, own) in zip(r.n_best, best):
            swaps = dict(x.swaps)
            made = [i for k, w in enumerate(words) for i in (swaps[k] if k in swaps else np.frombuffer(lattice.known[w][0], np.int32).tolist())]
            assert lattice.decode(made) == r.text and len(made) == len(own)
    marked = pieces.encode_all(docs(spark, [(1, "a▁b", "s"), (2, " a  b ", "s")]), path).collect()
    assert {r.doc_id: r.round_trip for r in marked} == {1: False, 2: True}
    made = pieces.encode_all(odd, path)
    assert ids(made) == ALL and {r.doc_id: r.n_pieces for r in made.collect()}[2] == 0
    assert pieces.encode_all(none, path).count() == 0


def brute_components(rows, size):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_are_those_of_brute_force(spark, documents, size):
    base = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    words = base[0][1].split()
    # A group of copies whose neighbours alone are alike, and sets of very few shingles.
    chain = [(10_000 + k, " ".join(words[3 * k : 3 * k + 120])) for k in range(20)]
    tiny = [(20_000 + k, t) for k, t in enumerate(["a b c d e f", "a b c d e f g", "A b  c d e f", "x", "x", "y", "", "x y"])]
    rows = base + chain + tiny
    made = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.find(docs(spark, [(d, t, "s") for d, t in rows]), size).collect()}
    want = brute_components(rows, size)
    assert made == {d: (n, c, c == d) for d, (n, c) in want.items()}


def test_near_duplicates_edges(spark, odd, none):
    made = neardup.find(odd, 2).collect()
    assert sorted((r.doc_id for r in made), key=lambda x: (x is None, x)) == ALL
    by = {r.doc_id: r for r in made}
    assert by[2].n_shingles == by[3].n_shingles == 0 and by[2].kept and by[3].kept and by[None].component_id is None
    assert neardup.find(none, 2).count() == 0
    one = neardup.keep_one(odd, 2)
    assert one.columns == odd.columns and ids(one) == [1, 2, 3, 4, 5, None]


def test_large_group_of_near_copies_is_one_component(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MEMBERS", 16)
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(words[:k % 180] + [f"own{k}"] + words[k % 180 + 1 :]), "s") for k in range(600)]
    made = neardup.find(docs(spark, rows), 2)
    assert made.where("component_id <> 0").count() == 0


@pytest.mark.parametrize("at", ["first", "middle", "last"])
@pytest.mark.parametrize("copies", [40, 1500])
def test_star_of_copies_is_one_component_wherever_its_original_stands(spark, copies, at):
    """Copies are alike to the original (0.82) but not to each other (about 0.68)."""
    words = [f"w{k}" for k in range(400)]
    made = []
    for k in range(copies):
        r = random.Random(k)
        text = list(words)
        for p in r.sample(range(1, 399), 20):
            text[p] = f"own{k}x{p}"
        made.append(" ".join(text))
    made.insert({"first": 0, "middle": copies // 2, "last": copies}[at], " ".join(words))
    rows = [(k, t, "s") for k, t in enumerate(made)]
    assert neardup.find(docs(spark, rows), 2).where("component_id <> 0").count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100)] + [(500, k) for k in range(501, 560)] + [(900, 901), (901, 900)]
    made = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {made[k] for k in range(1, 101)} == {0} and {made[k] for k in range(501, 560)} == {500} and made[901] == 900


def test_components_need_no_round_to_see_that_stars_are_settled(spark, monkeypatch):
    from vigora.llm import components as module

    rounds, plain = [], module._large_star
    monkeypatch.setattr(module, "_large_star", lambda edges: rounds.append(1) or plain(edges))
    stars = spark.createDataFrame([(1, k) for k in range(2, 50)] + [(60, 61)], "a long, b long")
    assert {(r.node, r.component) for r in components(stars).collect()} == {(k, 1) for k in range(2, 50)} | {(61, 60)} and not rounds
    joined = stars.union(spark.createDataFrame([(61, 30)], "a long, b long"))
    assert {r.component for r in components(joined).collect()} == {1} and rounds


def test_mixing_meets_its_budget_and_limit(spark, odd, none):
    r = [(k, " ".join(["w"] * (1 + k % 7)), "big" if k % 3 else f"s{k % 5}") for k in range(3000)]
    made = mixing.mix(docs(spark, r), max_repeats=1.5)
    got = made.select("_row.doc_id", "_row.source", "tokens", "copy", "weight").collect()
    total = sum(1 + k % 7 for k, _, _ in r)
    used, have = collections.Counter(), collections.Counter()
    for k, t, s in r:
        have[s] += len(t.split())
    for x in got:
        used[x.source] += x.tokens
    weights = {x.source: x.weight for x in got}
    assert sum(weights.values()) == pytest.approx(1)
    for s in have:
        assert used[s] <= weights[s] * total + 1e-6 and used[s] > weights[s] * total - 8
        assert weights[s] * total / have[s] <= 1.5 + 1e-6
    assert max(weights[s] * total / have[s] for s in have) == pytest.approx(1.5, abs=1e-3)
    copies = collections.Counter(x.doc_id for x in got)
    for s in have:
        mine = [copies[k] for k, _, x in r if x == s]
        assert max(mine) - min(mine) <= 1
    half = mixing.mix(docs(spark, r), target_entropy=0.9, max_repeats=None).select("weight", "_row.source").distinct().collect()
    assert -sum(x.weight * math.log(x.weight) for x in half) == pytest.approx(0.9, abs=1e-4)
    assert mixing.mix(none).count() == 0 and mixing.mix(none).select("_row.*").columns == none.columns
    again = mixing.mix(odd, max_repeats=None).select("_row.*")
    assert again.columns == odd.columns and again.count() > 0
    assert mixing.mix(docs(spark, [(1, None, "a"), (2, "", "b")])).count() == 0


def test_mixing_holds_both_limits_or_says_so(spark):
    r = docs(spark, [(k, " ".join(["w"] * (1 + k % 7)), "big" if k % 3 else f"s{k % 5}") for k in range(600)])
    total = sum(1 + k % 7 for k in range(600))
    with pytest.raises(ValueError, match="limit is 1.25"):
        mixing.mix(r, budget=6 * total, max_repeats=1.25)
    with pytest.raises(ValueError, match="largest source"):
        mixing.mix(r, target_entropy=0.3, max_repeats=1.0)
    with pytest.raises(ValueError, match="no exponent"):
        mixing.mix(r, target_entropy=-1.0, max_repeats=None)
    both = mixing.mix(r, target_entropy=1.2, max_repeats=1.5).select("weight", "_row.source").distinct().collect()
    assert -sum(x.weight * math.log(x.weight) for x in both) <= 1.2 + 1e-6
    have = collections.Counter()
    for x in r.select("source", "text").collect():
        have[x.source] += len(x.text.split())
    assert all(x.weight * total / have[x.source] <= 1.5 + 1e-6 for x in both)
    six = mixing.mix(r, budget=6 * total, max_repeats=6.5).groupBy("_row.doc_id").count().agg(F.max("count")).first()[0]
    assert six <= 7


def test_mixing_of_ties_and_one_source_is_that_of_brute_force(spark):
    """Rows of one id and equal tokens; half the budget: about half the tokens, whole rows, each at most once."""
    rows = [(k // 2, "a b c", "one") for k in range(4000)] + [(9000, None, "one"), (9001, "", "two")]
    made = mixing.mix(docs(spark, rows), budget=6000).select("_row.doc_id", "tokens", "copy").collect()
    by = collections.Counter(x.doc_id for x in made)
    assert set(by.values()) <= {1, 2} and all(n == 2 for d, n in by.items() if d < 9000)
    assert 6000 - 6 <= sum(x.tokens for x in made) <= 6000


def test_quotes_are_linked_and_removed(spark):
    rows = [
        (1, 0, "user", "How do I open the door?\nIt is locked."), (1, 1, "assistant", "> How do I  open the DOOR?\n> It is locked.\nUse the key."),
        (1, 2, "user", ">> It is locked.\n> Use the key.\nWhich one?"), (1, 3, "user", "> never said\nHm."), (1, 3, "user", "> never said\nHm."),
        (2, 5, "user", "On Monday, A wrote:\n> Use the key.\nFrom elsewhere"), (3, 0, None, None), (None, None, "user", "lost"), (4, 0, "user", LONG),
    ]
    made = {r.conv_id: r for r in quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("level", F.lit(1))).collect()}
    one = made[1]
    assert (one.n_messages, one.n_quotes, one.n_linked) == (4, 4, 3)
    assert [m.content for m in one.messages] == ["How do I open the door?\nIt is locked.", "Use the key.", "Which one?", "Hm."]
    assert [(m.reply_conv, m.reply_turn) for m in one.messages] == [(None, None), (1, 0), (1, 1), (1, 2)]
    assert made[2].messages[0].content == "From elsewhere" and (made[2].messages[0].reply_conv, made[2].messages[0].reply_turn) == (1, 1)
    assert made[3].messages[0].content == "" and made[None].n_messages == 1 and made[4].messages[0].content == LONG
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.conversations(empty).count() == 0


def test_quotes_from_elsewhere_though_the_own_conversation_says_it_later(spark):
    rows = [
        (1, 0, "user", "Hello."), (1, 2, "user", "> Use the key.\nWhy?"), (1, 4, "user", "Use the key."),
        (2, 0, "user", "Use the key."), (3, 0, "user", "Use the key."), (3, 1, "user", "> Hello.\nHello."),
    ]
    made = {r.conv_id: r for r in quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert (made[1].n_linked, made[1].messages[1].reply_conv, made[1].messages[1].reply_turn) == (1, 2, 0)
    assert (made[3].n_linked, made[3].messages[1].reply_conv, made[3].messages[1].reply_turn) == (1, 1, 0)


def brute_reply_order(replies):
    """replies: for each message (from 1) the one it quotes, or None. Depth first: quoting messages in order, then the next message."""
    n, follows, quoting = len(replies), {}, collections.defaultdict(list)
    for k, target in enumerate(replies, 1):
        if target is None:
            if k > 1:
                follows[k - 1] = k
        else:
            quoting[target].append(k)
    out = []

    def go(k):
        out.append(k)
        for c in quoting[k]:
            go(c)
        if k in follows:
            go(follows[k])

    go(1)
    assert sorted(out) == list(range(1, n + 1))
    return out


def brute_links(rows):
    """(conv, turn, role, text) -> (quotes, linked, target): each passage looked for in all messages, the whole first, then its lines, the longest first; in the own conversation before, else in the least other one."""
    normal = lambda x: re.sub(r"\s+", " ", x.lower()).strip(" ")
    marks, said, parsed = re.compile(quotes.MARKS), collections.defaultdict(dict), {}
    for row in sorted(set(rows), key=str):
        lines = [((m := marks.match(x)) and m[0].count(">") or 0, marks.sub("", x, count=1) if not (m := marks.match(x)) else x[m.end() :].removeprefix(" ")) for x in (row[3] or "").split("\n")]
        quoted = any(level for level, _ in lines)
        own = "\n".join(x for level, x in lines if not level and not re.match(quotes.ATTRIBUTION.replace("(?i)", ""), x, re.I)) if quoted else row[3] or ""
        own = re.sub(r"\n{3,}", "\n\n", own).strip(" ") if quoted else own
        for key in {normal(x) for x in [own, *re.split(r"\n\s*\n", own), *own.split("\n")]} - {""}:
            said[key][row[0]] = min(said[key].get(row[0], row[1]), row[1])
        passages = [(level, "\n".join(x for _, x in group)) for level, group in ((k, list(g)) for k, g in itertools.groupby(lines, key=lambda x: x[0])) if level] if quoted else []
        parsed[row] = [(k, level, t) for k, (level, t) in enumerate(passages) if normal(t)]
    out = {}
    for (conv, turn, _, _), passages in ((r, p) for r, p in parsed.items()):
        links = []
        for k, level, t in passages:
            keys = [normal(t), *sorted({normal(x) for x in t.split("\n")} - {""}, key=lambda x: (-len(x), x))]
            here = next(((conv, said[x][conv]) for x in keys if said.get(x, {}).get(conv, turn) < turn), None)
            there = next((min((c, n) for c, n in said[x].items() if c != conv) for x in keys if set(said.get(x, ())) - {conv}), None)
            links.append((level, k, here or there))
        found = [x for x in links if x[2]]
        out[conv, turn] = (len(links), len(found), min(found)[2] if found else None)
    return out


def test_quotes_of_the_table_are_linked_as_by_brute_force(spark, small):
    messages = table(spark, small, "conversations").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in messages.collect()]
    r = random.Random(4)
    lines = [x for row in rows for x in (row[3] or "").split("\n") if x.strip() and not x.startswith(">")]
    for c in range(40):
        rows += [(10_000 + c, t, "user", "\n".join(f"{'>' * r.randint(1, 2)} {r.choice(lines)}" for _ in range(r.randint(1, 3))) + f"\nown {c} {t}") for t in range(3)]
    made = {}
    for x in quotes.conversations(spark.createDataFrame(rows, messages.schema)).collect():
        assert x.n_messages == len(x.messages)
        made[x.conv_id] = (x.n_quotes, x.n_linked, {m.turn: (m.reply_conv, m.reply_turn) for m in x.messages})
    want = brute_links(rows)
    for conv, (n_quotes, n_linked, replies) in made.items():
        mine = {t: v for (c, t), v in want.items() if c == conv}
        assert (n_quotes, n_linked) == (sum(v[0] for v in mine.values()), sum(v[1] for v in mine.values())), conv
        for t, (_, linked, target) in mine.items():
            if target:
                assert replies[t] == target, (conv, t)


def test_quotes_give_reply_order(spark):
    r, rows, want = random.Random(8), [], {}
    cases = [[None, None, None, 1], [None, 1, 2, 1, 3], [None, 1, 1, 1, 2, 4], [None]] + [[None] + [r.choice([None, r.randint(1, k), k]) for k in range(1, r.randint(2, 25))] for _ in range(25)]
    for c, replies in enumerate(cases):
        want[c] = brute_reply_order(replies)
        for k, target in enumerate(replies, 1):
            rows.append((c, k, "user", (f"> text {target} of {c} here\n" if target else "") + f"text {k} of {c} here"))
    made = quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {x.conv_id: [m.turn for m in x.messages] for x in made} == want
    assert all([m.position for m in x.messages] == list(range(1, len(x.messages) + 1)) for x in made)


def test_quotes_with_ties_and_deep_nesting(spark):
    rows = [(1, 1, "b", "x y z"), (1, 1, "a", "u v w"), (1, 2, "a", "> x y z\nfirst"), (1, None, "a", "none")]
    deep = [(2, 1, "u", "line 1 deep")] + [(2, k, "u", f"> line {max(1, k - 2)} deep\nline {k} deep") for k in range(2, 40)]
    made = {x.conv_id: x.messages for x in quotes.conversations(spark.createDataFrame(rows + deep, "conv_id long, turn long, role string, text string")).collect()}
    # Of one turn, the first message is the one that is answered.
    assert [(m.turn, m.role) for m in made[1]] == [(None, "a"), (1, "a"), (2, "a"), (1, "b")]
    assert [m.turn for m in made[2]] == brute_reply_order([None] + [max(1, k - 2) for k in range(2, 40)])


def test_long_conversations_come_in_parts_in_order(spark):
    rows = [(7, k, "user", f"message {k}") for k in range(50)]
    made = quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), part=8).orderBy("part").collect()
    flat = [m for r in made for m in r.messages]
    assert [m.position for m in flat] == list(range(1, 51)) and [m.turn for m in flat] == list(range(50))
    assert [m.reply_turn for m in flat] == [None, *range(49)] and max(r.n_messages for r in made) == 8


def test_html_uses_the_host_s_path(spark):
    main = "<body><div class='story7'><p>{}</p></div><div class='links'><p>{}</p></div></body>"
    rows = [(k, f"https://h.example/{k}", main.format("Long text of the story. " * 5, "short")) for k in range(5)]
    rows += [(9, "https://h.example/9", main.format("Tiny.", "This host keeps links here, and they are long today.")), (10, None, None), (11, "not a url", ""), (9, "https://h.example/9", main.format("Tiny.", "x" * 60))]
    made = html.extract_all(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("x"))).collect()
    assert len(made) == len(rows) and {r.text for r in made if r.page_id == 9} == {"Tiny."}
    assert {r.page_id: r.n_chars for r in made}[10] == 0
    assert html.extract_all(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_neighbours_on_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (40, [float("inf"), 1.0]), (60, [])]
    base = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    made = neighbours.search(base, base.where("id % 20 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in made] == [(0, 1, 3, 1.0), (0, 2, 4, 1.0), (0, 3, 20, 0.0), (20, 1, 3, 2.0), (20, 2, 4, 2.0), (20, 3, 0, 0.0)]
    empty = neighbours.usable(spark.createDataFrame([], "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert neighbours.search(empty, empty).count() == 0


def test_neighbours_of_repeated_ids_are_as_many_and_distinct(spark):
    r = random.Random(5)
    vectors = [(k, [r.gauss(0, 1) for _ in range(16)]) for k in range(400)]
    again = [(7, [x + 0.01 * k for x in vectors[7][1]]) for k in range(31)] + [(20, [-x for x in vectors[20][1]])]
    rows = vectors + again + vectors[:50]
    base = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    made = neighbours.search(base, base.where("id % 20 = 0")).collect()
    asked = {d: min(v for e, v in rows if e == d) for d in range(0, 400, 20)}
    by = collections.defaultdict(list)
    for x in sorted(made, key=lambda x: (x.query_id, x.rank)):
        by[x.query_id].append((x.vec_id, x.score))
    hit = 0
    for q, own in asked.items():
        best = {}
        for e, v in rows:
            if e != q:
                s = sum(a * b for a, b in zip(own, v))
                best[e] = max(best.get(e, s), s)
        want = sorted(best, key=lambda e: (-best[e], e))[:20]
        assert len({e for e, _ in by[q]}) == len(by[q]) == 20
        assert all(s == pytest.approx(best[e]) for e, s in by[q])
        hit += len(set(want) & {e for e, _ in by[q]})
    assert hit >= 0.9 * 20 * len(asked)


def test_neighbours_in_many_blocks_and_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_BYTES", 8 * 16 * 10)
    x = np.random.default_rng(3).standard_normal((1500, 16))
    base = neighbours.usable(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>"), "vec_id", "embedding")
    made = collections.defaultdict(list)
    for r in neighbours.search(base, base.where("id % 100 = 0")).orderBy("query_id", "rank").collect():
        made[r.query_id].append(r.vec_id)
    hit = 0
    for q, found in made.items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(found) & set(np.argsort(-s, kind="stable")[:20].tolist()))
    assert len(made) == 15 and hit >= 0.9 * 20 * 15


def test_neighbours_recall_on_the_table(spark, small):
    rows = table(spark, small, "embeddings").select("vec_id", "embedding").collect()
    x, key = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    base = neighbours.usable(table(spark, small, "embeddings"), "vec_id", "embedding")
    found = collections.defaultdict(set)
    for r in neighbours.search(base, base.where("id % 20 = 0")).collect():
        found[r.query_id].add(r.vec_id)
    hit = 0
    for q in found:
        s = x @ x[key == q][0]
        s[key == q] = -np.inf
        hit += len(found[q] & set(key[np.lexsort((key, -s))[:20]]))
    assert hit >= 0.9 * 20 * len(found)


def test_language_model_counts_and_beats_the_base(spark, small, documents):
    got = {r.doc_id: r for r in lm.op10_lm(spark, small).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b"\n"] for r in documents.collect()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 10 == 0}
    counts = collections.Counter(w for d, ws in texts.items() if d not in held for w in ws)
    n, v = sum(counts.values()), len(counts)
    for d, ws in texts.items():
        assert (got[d].held_out, got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (d in held, len(ws), sum(counts[w] > 0 for w in ws), n)
        assert got[d].base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
    assert sum(got[d].score for d in held) > sum(got[d].base_score for d in held)


def test_language_model_s_vocabulary_fits_whatever_the_counts(spark):
    rows = [(f"w{k}", 7) for k in range(400)] + [("often", 5000), ("most", 9000)]
    counts = spark.createDataFrame(rows, "word string, c long")
    for most, least in ((1000, 402), (100, 60), (2, 2), (1, 1)):
        got = {r.word for r in counts.where(lm.frequent(counts, most)).collect()}
        assert least <= len(got) <= max(most * 1.4, 2) and "most" in got
        assert most < 2 or "often" in got


def test_language_model_s_score_is_that_of_its_model(spark, small, documents, monkeypatch):
    """Scores of the query against the model's own tables, looked up one token at a time; with most words rare."""
    monkeypatch.setattr(lm, "VOCABULARY", 300)
    training = documents.where(crc_mod("doc_id", 10) != 0)
    counts = lm.checkpointed(lm.count_words(training))
    model = lm.fit(training, counts, 300)
    assert len(model.vocabulary) <= 400
    got = {r.doc_id: r.score for r in lm.score(documents, model, counts, F.lit(True)).collect()}
    c = {r.word: r.c for r in counts.collect()}
    own, seq, weights = {w: k for k, w in enumerate(model.vocabulary)}, lm.Sequences(model.vocabulary), lm.Weights(model.tree, model.weights, model.cells)
    whole = np.cumsum(model.cells, axis=1)
    for r in documents.where("length(text) < 1500").limit(25).collect():
        ids, at, _ = seq.batch([r.text])
        want = 0.0
        for k, w in zip(at, [*lm.words(r.text), None]):
            one = np.array([k])
            leaf = seq.leaves(ids[one])
            want += weights.score(lm.histories(ids, one, seq, model.tree), leaf, whole, model.smooth())[0] / math.log(10)
            if w is not None and w.decode() not in own:
                x = zlib.crc32(w) % lm.RARE_LEAVES
                want += math.log10(c.get(w.decode(), 0) + 0.1) - math.log10(model.rare[x] + 0.1 * (model.rare_words[x] + 1))
        assert got[r.doc_id] == pytest.approx(want, rel=1e-4)


def test_language_model_sends_rare_words_in_blocks(spark, documents, monkeypatch):
    """Shuffled rows of scoring: one a chunk of texts and bucket, and not one a text and rare word; the scores stay, however texts are cut into chunks."""
    training = documents.where(crc_mod("doc_id", 10) != 0)
    counts = lm.checkpointed(lm.count_words(training))
    model = lm.fit(training, counts, 300)
    whole = sorted(map(tuple, lm.score(documents.union(documents), model, counts, F.lit(True)).collect()))
    monkeypatch.setattr(lm, "CHUNK_WORDS", 3000)
    parts = sorted(map(tuple, lm.score(documents.union(documents), model, counts, F.lit(True)).collect()))
    assert len(parts) == 2 * documents.count() and [p[:5] for p in parts] == [w[:5] for w in whole]
    assert all(p[5:] == pytest.approx(w[5:]) for p, w in zip(parts, whole))
    asked = lm._Asked(4)
    for text in range(500):
        asked.ask(text, collections.Counter({f"w{text}".encode(): 2, b"both": 1}))
    asked.sums, asked.texts = [([None] * 500, np.ones(500, int), np.ones(500, int), np.zeros(500), np.zeros(500))], 500
    (rows,) = asked.rows(7)
    assert rows.num_rows == 5
    table_ = pa.table({"word": ["both", "w3"], "c": [9, 4]})
    made = lm._summed(pa.concat_tables([lm._answer(pa.Table.from_batches([rows]), table_)]))
    assert made.num_rows == 500 and made.column("doc_id").null_count == 500
    assert made.column("n_known").to_pylist() == [4 if k == 3 else 2 for k in range(500)]
    assert made.column("base").to_pylist()[3] == pytest.approx(math.log10(9.1) + 2 * math.log10(4.1))


def test_language_model_on_odd_tables(spark, odd, none, tmp_path):
    for name, df, n in (("odd", odd, len(ODD)), ("none", none, 0)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        made = lm.op10_lm(spark, f"{tmp_path}/{name}").collect()
        assert len(made) == n and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in made)
        assert {r.n_tokens for r in made if r.doc_id in (2, 3)} <= {1}


def test_workers_get_long_texts_a_few_at_a_time(spark):
    """What an executor and a worker hold at once is bounded by bytes: 40 texts of a megabyte are not one batch."""
    from vigora.llm.common import BATCH_BYTES, map_arrow

    rows = spark.range(0, 40, 1, 1).select(F.expr("repeat('word and ', 125000)").alias("text"))
    made = [r.n for r in map_arrow(rows, lambda: lambda c: {"n": [sum(map(len, c["text"]))]}, "n long").collect()]
    assert sum(made) == 40 * 9 * 125_000 and max(made) <= BATCH_BYTES + 9 * 125_000


def test_workers_keep_no_model_of_a_stage_that_is_over(spark, documents):
    """A worker remembers its lattice from task to task, but not into the tasks of other operators."""
    import public_tokenizers

    from vigora.llm.common import map_arrow

    def count():
        import gc

        return lambda c: {"n": [sum(type(x).__name__ == "Lattice" for x in gc.get_objects())]}

    def count_kept():
        pieces.lattice(path)
        return count()

    path = public_tokenizers.path("piece_bpe_32k.model")
    parts = documents.repartition(4)
    for _ in range(2):
        assert pieces.encode_all(parts, path).count() == documents.count()
    assert {r.n for r in map_arrow(parts.select("text"), count_kept, "n long", keeps=True).collect()} == {1}
    assert {r.n for r in map_arrow(parts.select("text"), count, "n long").collect()} == {0}
