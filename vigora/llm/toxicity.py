"""Toxicity by a weighted finite-state pattern grammar.

Words of a clause become symbols: insult, threat, target, negation, reported
speech, other. The arcs of the transducers have weights, which multiply along a
path, and when transducers are composed: insults and threats have their own, an
arc that finds one in the scope of a negation, of reported speech or of a target
has that mark's. Negation, reported speech and targets before the word are
composed into one machine, which reads a clause forward; targets after the word
are found by another, which reads what the first has written backward, so that
"idiot, you" is seen as "you idiot" is. A clause scores its heaviest word, with
the weight of the word in the lexicon; a document's score is the noisy-or of its
clauses over the rate of documents without a match.

The insult lexicon (whole words, and stems that stand for all words beginning
with them) and the arcs' weights are learned from labelled rows. Targets,
negators, reporting verbs and threats are closed word lists below.

Defined results: null or empty texts have no match and get the base rate; very
long texts are scored whole, clause by clause; null labels are not learned from;
repeated rows are scored alike, each for itself, and a repeated label row counts
once (the larger label); of equally good features the word comes before the
stem, then the more frequent, then the shorter; with no labels the lexicon is
empty and every score is the default base rate; an empty table gives no rows;
other columns, whatever their names, take no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigora.llm.common import crc_mod, keep_texts, map_arrow, table

#: Closed classes of the grammar, English, German, French, Spanish.
TARGETS = "you your yourself they them he she him her people du dich dir ihr euch sie er tu toi te vous ils elles lui usted ustedes ellos ellas él ella vosotros".split()
NEGATORS = "not never no isn't aren't wasn't nobody nicht kein keine nie jamais pas aucun aucune no nunca ningún ninguna".split()
REPORTERS = "said says say called calls claimed wrote quoted reported alleged sagte nannte schrieb behauptete dit appelé écrit prétend dijo llamó escribió afirmó".split()
THREATS = "kill murder strangle stab shoot umbringen töten erschießen tuer étrangler poignarder matar asesinar apuñalar".split()
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "itynro"
#: Marks that a word may get from what stands around it, and what the arcs weigh before anything is learned.
NEGATED, REPORTED, TARGETED = "-", "\"", "@"
MARKS = NEGATED + REPORTED + TARGETED
PRIOR = {INSULT: 0.8, THREAT: 0.2, INSULT + NEGATED: 0.4, INSULT + REPORTED: 0.4, INSULT + TARGETED: 1.1, THREAT + NEGATED: 0.5, THREAT + REPORTED: 0.7, THREAT + TARGETED: 3.0}
NAMES = {INSULT: "insult", THREAT: "threat", NEGATED: "negated", REPORTED: "reported", TARGETED: "target"}
#: No mark makes a word count more than this, or less.
LEAST_MARK, MOST_MARK = 0.05, 20.0
#: Weight of the prior, in documents.
PRIOR_DOCUMENTS = 8
#: Bound on the labelled rows learned from (those with the smallest hashes), and the lengths of stems.
MAX_LABELLED, STEMS = 20_000, (4, 5, 6, 7)
THRESHOLD = 0.3
WORD, CLAUSE = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?"), re.compile(r"[.!?;\n]+")


class Transducer:
    """A complete sequential transducer with weights: (state, symbol) -> (state, symbol, weight); unknown symbols pass with weight 1 and move by ``default``."""

    def __init__(self, arcs: dict, default: dict, start=0):
        self.arcs, self.default, self.start = arcs, default, start

    def step(self, state, symbol):
        if (found := self.arcs.get((state, symbol))) is not None:
            return found
        return self.default[state], symbol, 1.0

    def compose(self, other: Transducer, symbols: str) -> Transducer:
        """The transducer that applies ``self``, then ``other``, by the product construction over reachable states; weights multiply."""
        start, arcs, default, todo = (self.start, other.start), {}, {}, [(self.start, other.start)]
        while todo:
            state = todo.pop()
            if state in default:
                continue
            default[state] = (self.default[state[0]], other.default[state[1]])
            for symbol in symbols:
                a, middle, x = self.step(state[0], symbol)
                b, out, y = other.step(state[1], middle)
                arcs[state, symbol] = ((a, b), out, x * y)
                todo.append((a, b))
            todo.append(default[state])
        return Transducer(arcs, default, start)

    def run(self, symbols, weights):
        """Output symbols and weights, each weight times that of the arc taken."""
        state, out, heavy = self.start, [], []
        for symbol, w in zip(symbols, weights):
            state, made, x = self.step(state, symbol)
            out.append(made)
            heavy.append(w * x)
        return out, heavy


#: All that an insult or threat may have become: its symbol and the marks so far, in the order in which they are given.
WRITTEN = [base + n + r + t for base in (INSULT, THREAT) for n in ("", NEGATED) for r in ("", REPORTED) for t in ("", TARGETED)]


def _scoped(trigger: str, mark: str, scope: int, weights: dict[str, float]) -> Transducer:
    """Marks insults and threats within ``scope`` words after ``trigger``, where they have no such mark, with the weight of the mark for such a word."""
    arcs, default = {}, {0: 0} | {k: k - 1 for k in range(1, scope + 1)}
    for state in default:
        arcs[state, trigger] = (scope, trigger, 1.0)
        if state:
            for base in WRITTEN:
                if mark not in base:
                    arcs[state, base] = (default[state], base + mark, weights[base[0] + mark])
    return Transducer(arcs, default)


def grammar(weights: dict[str, float]) -> tuple[Transducer, Transducer]:
    """The machine that reads forward (words o negation o reported speech o targets before) and that which reads backward (targets after)."""
    symbols = INSULT + THREAT + TARGET + NEGATION + REPORT + OTHER
    words = Transducer({(0, s): (0, s, weights[s]) for s in (INSULT, THREAT)}, {0: 0})
    forward = words.compose(_scoped(NEGATION, NEGATED, 3, weights), symbols).compose(_scoped(REPORT, REPORTED, 8, weights), symbols)
    return forward.compose(_scoped(TARGET, TARGETED, 4, weights), symbols), _scoped(TARGET, TARGETED, 2, weights)


def _name(symbol: str) -> str:
    """A written symbol as words: "insult+negated+target"."""
    return "+".join(NAMES[c] for c in symbol)


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    arcs: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    base: float = 0.05

    def compiled(self):
        """text -> the written symbol and the weight of the heaviest word of each clause that has one."""
        (forward, backward), closed = grammar(self.arcs), {}
        for kind, words in ((TARGET, TARGETS), (NEGATION, NEGATORS), (REPORT, REPORTERS), (THREAT, THREATS)):
            closed |= dict.fromkeys(words, kind)
        strong = [re.escape(w) for w in sorted([*self.words, *THREATS], key=len, reverse=True)]
        lengths = sorted({len(s) for s in self.stems})
        wanted = re.compile(r"(?<![^\W_])(?:" + "|".join([rf"(?:{'|'.join(strong)})(?![^\W\d_])"] + [re.escape(s) for s in sorted(self.stems)]) + ")")

        def symbol(word: str) -> tuple[str, float]:
            if (p := self.words.get(word)) is not None:
                return INSULT, p
            for n in lengths:
                if len(word) > n and (p := self.stems.get(word[:n])) is not None:
                    return INSULT, p
            return closed.get(word, OTHER), 1.0

        def clauses(text: str) -> list[tuple[str, float]]:
            low = text.lower()
            out, end = [], -1
            for m in wanted.finditer(low):
                if m.start() < end:
                    continue
                a = max(low.rfind(c, 0, m.start()) for c in ".!?;\n") + 1
                b = CLAUSE.search(low, m.end())
                end = b.start() if b else len(low)
                words = [symbol(w) for w in WORD.findall(low[a:end])]
                written, heavy = forward.run([k for k, _ in words], [x for _, x in words])
                written, heavy = backward.run(written[::-1], heavy[::-1])
                made = [(min(w, 1.0), k, s) for k, (s, w) in enumerate(zip(written, heavy)) if s[0] in (INSULT, THREAT)]
                if made:
                    w, _, s = max(made, key=lambda x: x[:2])
                    out.append((s, w))
            return out

        return clauses

    def scorer(self):
        clauses = self.compiled()

        def score(text: str | None) -> tuple[float, list[tuple[str, float]]]:
            found = clauses(text) if text else []
            clean = math.log1p(-self.base) + sum(math.log1p(-min(0.9999, w)) for _, w in found)
            return 1 - math.exp(clean), found

        return score


def _features(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return {f"w{w}" for w in words} | {f"s{w[:n]}" for w in words for n in STEMS if len(w) > n}


def sample(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """At most ``limit`` labelled training rows, those with the smallest hashes of their ids; bounded, so it may be broadcast."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", 4) != 2))
    # A cut on the hashes first, so that no task sends ``limit`` rows for the top-k.
    share, h = min(1.0, (1.2 * limit + 100) / max(1, usable.count())), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    rows = usable.where(h < int(share * (1 << 20)) + 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return rows.orderBy(h, "doc_id").limit(limit)


def fit(documents: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """Learns the lexicon, by a greedy cover of the toxic documents with words and stems that clean documents lack, and the arcs' weights."""
    marked = documents.select("doc_id", "text").join(F.broadcast(sample(labels, limit)), "doc_id")

    def count():
        def f(c):
            seen = defaultdict(lambda: [0, 0])
            for text, toxic in zip(c["text"], c["toxic"]):
                for x in _features(text or ""):
                    seen[x][toxic > 0] += 1
            return {"feature": list(seen), "pos": [v[1] for v in seen.values()], "neg": [v[0] for v in seen.values()]}
        return f

    counts = map_arrow(marked.select("text", "toxic"), count, "feature string, pos long, neg long", rows=4096)
    # What fewer toxic documents have than a feature must cover can never be taken, so it is left behind.
    least = max(2, math.ceil(0.004 * marked.where("toxic > 0").count()))
    candidates = (
        counts.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where((F.col("pos") >= max(3, least)) & F.expr("pos >= 20 * neg")).collect()
    )  # of a sample of fixed size, so bounded
    known = {r.feature: (r.pos, r.neg) for r in candidates}
    model = Model()

    def incidence():
        def f(c):
            found = [[x for x in _features(t or "") if x in known] for t in c["text"]]
            return {"found": found}
        return f

    toxic = [set(r.found) for r in map_arrow(marked.where("toxic > 0").select("text"), incidence, "found array<string>").collect()]
    left = dict(enumerate(toxic))
    while left:
        gains = Counter(x for fs in left.values() for x in fs)
        best = max(gains, key=lambda x: (gains[x] - 3 * known[x][1], x[0] == "w", known[x][0], -len(x), x), default=None)
        if best is None or gains[best] - 3 * known[best][1] < least:
            break
        pos, neg = known[best]
        (model.words if best[0] == "w" else model.stems)[best[1:]] = (pos + 0.5) / (pos + neg + 1)
        left = {k: fs for k, fs in left.items() if best not in fs}

    def marks():
        clauses = model.compiled()

        def f(c):
            seen = defaultdict(lambda: [0, 0])
            for text, toxic in zip(c["text"], c["toxic"]):
                found = clauses(text or "")
                # Each document counts for its heaviest clause.
                seen[max(found, key=lambda x: x[1])[0] if found else ""][toxic > 0] += 1
            return {"written": list(seen), "pos": [v[1] for v in seen.values()], "neg": [v[0] for v in seen.values()]}
        return f

    seen = {r.written: (r.pos, r.neg) for r in map_arrow(marked.select("text", "toxic"), marks, "written string, pos long, neg long").groupBy("written").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()}
    model.arcs = learned(seen)
    if "" in seen:
        pos, neg = seen[""]
        model.base = min(0.25, (pos + 0.5) / (pos + neg + 1))
    return model


def learned(seen: dict[str, tuple[int, int]]) -> dict[str, float]:
    """The arcs' weights from the toxic and other documents by written symbol.

    A word's weight is the rate of toxic documents among those where it has no
    mark; a mark's is the rate among those where the word has it, over what these
    weigh without it. Both are smoothed towards the prior.
    """
    arcs = dict(PRIOR)
    for base in (INSULT, THREAT):
        pos, neg = seen.get(base, (0, 0))
        arcs[base] = (pos + PRIOR_DOCUMENTS * PRIOR[base]) / (pos + neg + PRIOR_DOCUMENTS)
        for mark in MARKS:
            mine = [seen[s] for s in seen if s and s[0] == base and mark in s]
            expected = arcs[base] * (sum(p + n for p, n in mine) + PRIOR_DOCUMENTS)
            found = sum(p for p, _ in mine) + PRIOR_DOCUMENTS * arcs[base] * PRIOR[base + mark]
            arcs[base + mark] = min(MOST_MARK, max(LEAST_MARK, found / expected))
    return arcs


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_clauses (matched), worst (the heaviest word with its marks, null if none); one row for each row."""

    def make():
        scorer = model.scorer()

        def f(c):
            made = [scorer(t) for t in c["text"]]
            return {"doc_id": c["doc_id"], "score": [s for s, _ in made], "n_clauses": [len(x) for _, x in made], "worst": [_name(max(x, key=lambda y: y[1])[0]) if x else None for _, x in made]}
        return f

    return map_arrow(documents.select("doc_id", "text"), make, "doc_id long, score double, n_clauses long, worst string")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score(documents, fit(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_clauses", "worst")


def drop_toxic(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that score under ``threshold``, with their columns."""

    def make():
        scorer = model.scorer()
        return lambda text: scorer(text)[0] < threshold

    return keep_texts(documents, make)
