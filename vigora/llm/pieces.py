"""SentencePiece encoding and decoding with exact n-best segmentations.

A text's piece lattice has an arc for each piece that matches at each place.
Forward Viterbi gives the best score of every prefix; these scores are exact
heuristics for an A-star search that runs backward from the end, so that the
segmentations come out best first and nothing is expanded in vain.

No piece of the models served here goes on after the start of a new word, so
the lattice falls apart at word starts; what a word gives is remembered by a
worker for all its tasks, and the n best segmentations of a text are the n best
sums over words (only the n - 1 words whose second best costs least can differ
from their best).

Scores are the pieces' log probabilities. Models made of merges have merge
ranks instead of probabilities; rank r then stands for -log(r + 2), the
log probability of that rank under Zipf's law up to a constant. A character
without a piece costs ``UNKNOWN`` more than the worst piece and becomes its
UTF-8 bytes' pieces.

Defined results: null and empty texts have no pieces, score 0 and one empty
segmentation; decoding gives back the text, but that the model's own word mark
U+2581 in a text reads as a blank (``round_trip`` is false there); very long
texts and words are encoded whole; repeated rows and ids are encoded alike, each
for itself; of equal segmentations the one with the longer last pieces is the
best; an empty table gives no rows; other columns, whatever their names, are
left out.
"""

from __future__ import annotations

import functools
import heapq
import math
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vigora.llm.common import Remembered, kept, map_arrow, table
from vigora.llm.tries import Trie

MARK = "▁"
UNKNOWN = 10.0
#: Bounds on words remembered by a worker (twice as many at most), on their length, and on n-best lists.
MAX_WORDS, MAX_WORD, MAX_LISTS = 120_000, 64, 20_000
N_BEST = 4


class Lattice:
    """Encodes, decodes and gives n-best segmentations for one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i))]
        raw = {i: sp.get_score(i) for i in plain}
        if all(s == int(s) for s in raw.values()):
            self.score = {i: -math.log(r + 2) for r, i in enumerate(sorted(plain, key=lambda i: (-raw[i], i)))}
        else:
            self.score = raw
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown_id, self.unknown = sp.unk_id(), min(self.score.values()) - UNKNOWN
        if any(MARK in self.pieces[i].lstrip(MARK) for i in plain):
            raise ValueError("pieces go on over word starts")
        self.single = {self.pieces[i] for i in plain if len(self.pieces[i]) == 1}
        # An ASCII character without a piece is one byte: it is treated as that byte's piece, at the price of an unknown one.
        bare = {chr(b): i for b, i in self.bytes.items() if b < 128 and chr(b) not in self.single}
        self.single |= set(bare)
        self.trie = Trie([(self.pieces[i], i) for i in plain] + list(bare.items()))
        self.scores = np.full(n, -math.inf)
        self.scores[plain] = [self.score[i] for i in plain]
        self.scores[list(bare.values())] = self.unknown
        self.outer = re.compile("(?<=[^ ]) ").split
        self.matches = ahocorasick.Automaton()
        for i in plain:
            self.matches.add_word(self.pieces[i], (len(self.pieces[i]), self.score[i], i))
        for c, i in bare.items():
            self.matches.add_word(c, (1, self.unknown, i))
        self.matches.make_automaton()
        #: What words give, the mark before them left out; the n best of a word, by the word and n.
        self.known = Remembered(lambda word: self._solve(self.marked(word)), MAX_WORDS, MAX_WORD)
        self.lists = functools.lru_cache(MAX_LISTS)(self.search)

    @staticmethod
    def marked(word: str) -> str:
        """A word as it stands in the lattice."""
        return MARK + word.replace(" ", MARK)

    def cut(self, text: str) -> list[str]:
        """The words of a text, each with a mark before it that is left out; a word after several blanks has the rest of them."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " ":
            return self.outer(text.replace(MARK, " "))
        return text.split(" ")

    def arcs(self, part: str) -> list[list[tuple[int, float, int]]]:
        """By end: (length, score, piece id) of each arc; -1 is an unknown character."""
        found: list[list] = [[] for _ in range(len(part) + 1)]
        for end, arc in self.matches.iter(part):
            found[end + 1].append(arc)
        for at, c in enumerate(part):
            if c not in self.single:
                found[at + 1].append((1, self.unknown, -1))
        return found

    @staticmethod
    def forward(arcs) -> tuple[list[float], list]:
        """The best score of each prefix, and its last arc; of equal ones, the longer arc."""
        best, last = [0.0] + [-math.inf] * (len(arcs) - 1), [None] * len(arcs)
        for end in range(1, len(arcs)):
            for arc in arcs[end]:
                s = best[end - arc[0]] + arc[1]
                if s > best[end] or s == best[end] and arc[0] > last[end][0]:
                    best[end], last[end] = s, arc
        return best, last

    def _ids(self, part: str, path: list[tuple[int, int]]) -> list[int]:
        """path: (start, piece id)."""
        out = []
        for at, i in path:
            if i >= 0:
                out.append(i)
            else:
                out += [self.bytes.get(b, self.unknown_id) for b in part[at].encode("utf-8", "surrogatepass")]
        return out

    def _solve(self, part: str) -> tuple[bytes, float, float, bool]:
        """Ids (int32 in bytes, which cost no garbage collection), score, what the second best costs, whether decoding gives the part back.

        The two best scores of every prefix are kept, which gives the second
        best of the whole without a search. Matches come by their ends, longest
        first, so that of equal segmentations the one with the longer last
        piece stays.
        """
        n = len(part)
        best, second, last = [0.0] + [-math.inf] * n, [-math.inf] * (n + 1), [None] * (n + 1)
        plain = self.single.issuperset(part)
        found = ((end + 1, arc) for end, arc in self.matches.iter(part)) if plain else ((end, arc) for end, arcs in enumerate(self.arcs(part)) for arc in arcs)
        for end, arc in found:
            length, s, _ = arc
            x = best[end - length] + s
            if x > best[end]:
                second[end] = max(best[end], second[end - length] + s)
                best[end], last[end] = x, arc
            elif x > second[end]:
                second[end] = x
        path, end = [], n
        while end:
            length, _, i = last[end]
            end -= length
            path.append((end, i))
        path.reverse()
        ids = [i for _, i in path] if plain else self._ids(part, path)
        return array("i", ids).tobytes(), best[n], max(0.0, best[n] - second[n]), plain or self.joined(ids) == part

    def solve(self, words: list[str]) -> list[tuple[bytes, float, float, bool]]:
        """What ``_solve`` gives, for many words at once: the forward scores of all of them are found side by side."""
        marked = [self.marked(w) for w in words]
        known = self.single.issuperset
        if not known("".join(marked)):
            out = [None if known(m) else self._solve(m) for m in marked]
            plain = [k for k, made in enumerate(out) if made is None]
            for k, made in zip(plain, self.solve([words[k] for k in plain]) if plain else ()):
                out[k] = made
            return out
        lengths, bounds, places, ends, ids = self.trie.matches(marked)
        begin = np.cumsum(lengths + 1) - lengths - 1
        best, second = np.full(int((lengths + 1).sum()), -math.inf), np.full(int((lengths + 1).sum()), -math.inf)
        best[begin] = 0.0
        last, came, steps, bounds = np.zeros(len(best), np.int32), np.zeros(len(best), np.int64), self.scores[ids], bounds.tolist()
        for a, b in zip(bounds, bounds[1:]):
            start, end, s = places[a:b], ends[a:b], steps[a:b]
            x, old, low = best[start] + s, best[end], second[end]
            better = x > old
            second[end] = np.where(better, np.maximum(old, second[start] + s), np.maximum(low, x))
            won = end[better]
            best[won], last[won], came[won] = x[better], ids[a:b][better], start[better]
        at, which, found, owner = begin + lengths, np.arange(len(words)), [], []
        goal = at
        while len(at):
            found.append(last[at])
            owner.append(which)
            at = came[at]
            open_ = at != begin[which]
            at, which = at[open_], which[open_]
        owner, found = np.concatenate(owner[::-1]), np.concatenate(found[::-1])
        flat = found[np.argsort(owner, kind="stable")].astype(np.int32).tobytes()
        stops = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        return [(flat[a:b], x, y, True) for a, b, x, y in zip([0, *stops], stops, best[goal].tolist(), np.maximum(0.0, best[goal] - second[goal]).tolist())]

    def learn(self, words: set[str]) -> None:
        self.known.learn(words, self.solve)

    def search(self, part: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of one part: A-star from its end, the forward scores as heuristic."""
        arcs = self.arcs(part)
        best, _ = self.forward(arcs)
        out, queue, tick = [], [(-best[-1], 0, len(part), 0.0, None)], 0
        while queue and len(out) < n:
            cost, _, at, done, path = heapq.heappop(queue)
            if not at:
                steps = []
                while path:
                    step, path = path
                    steps.append(step)
                out.append((-cost, self._ids(part, steps)))
                continue
            for length, s, i in arcs[at]:
                tick += 1
                heapq.heappush(queue, (-(best[at - length] + s + done), tick, at - length, done + s, ((at - length, i), path)))
        return out

    def encode(self, text: str | None, n: int = 1) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a text, best first: (score, ids)."""
        words = self.cut(text or "")
        made = [self.known[w] for w in words]
        score = math.fsum(m[1] for m in made)
        open_at = sorted(cheapest([m[2] for m in made], n - 1))
        ways: list[tuple[float, tuple]] = [(0.0, ())]
        for k in open_at:
            other = self.lists(self.marked(words[k]), n)
            ways = heapq.nsmallest(n, ((loss + other[0][0] - s, (*picks, ids)) for loss, picks in ways for s, ids in other), key=lambda w: w[0])
        out = []
        for loss, picks in ways:
            swap = dict(zip(open_at, picks))
            out.append((score - loss, list(chain.from_iterable(swap[k] if k in swap else np.frombuffer(m[0], np.int32).tolist() for k, m in enumerate(made)))))
        return out

    def joined(self, ids) -> str:
        out, pending = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                pending.append(b)
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            out.append(self.pieces[i])
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids) -> str:
        text = self.joined(ids).replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


def cheapest(costs, k: int) -> list[int]:
    """Places of the k least finite costs, the earlier of equal ones."""
    c = np.asarray(costs)
    if len(c) > 4 * k > 0:
        under = np.flatnonzero(c <= np.partition(c, k - 1)[k - 1])
    else:
        under = np.arange(len(c))
    under = under[np.argsort(c[under], kind="stable")][:k]
    return [int(x) for x in under if c[x] < math.inf]


SCHEMA = "doc_id long, n_pieces long, score double, n_best array<struct<score double, swaps array<struct<word int, ids array<int>>>>>, round_trip boolean, ids array<int>"


def lattice(path: str) -> Lattice:
    """One lattice a worker, with all that it remembers."""
    return kept(Lattice, path)


def encode_all(documents: DataFrame, path: str, n: int = N_BEST) -> DataFrame:
    """A row of ids for each row, with the ``n`` best segmentations; no shuffle.

    n_best: each one's score, and the words in which it differs from the best
    (its numbers from 0, as ``Lattice.cut`` gives them) with their ids.
    """

    def make():
        own = lattice(path)

        def f(c):
            flat, ends, scores, n_best, whole = [], [0], [], [], []
            cut = [own.cut(text or "") for text in c["text"]]
            own.learn(set().union(*cut))
            for text, words in zip(c["text"], cut):
                made = tuple(zip(*map(own.known.__getitem__, words))) or ((), (), (), ())
                flat.append(b"".join(made[0]))
                ends.append(ends[-1] + len(flat[-1]) // 4)
                scores.append(math.fsum(made[1]))
                whole.append(all(made[3]) and MARK not in (text or ""))
                ways: list[tuple[float, tuple]] = [(0.0, ())]
                for k in cheapest(made[2], n - 1):
                    other = own.lists(own.marked(words[k]), n)
                    ways = heapq.nsmallest(n, ((loss + other[0][0] - s, (*swaps, (k, ids)) if j else swaps) for loss, swaps in ways for j, (s, ids) in enumerate(other)), key=lambda w: w[0])
                n_best.append([(scores[-1] - loss, swaps) for loss, swaps in ways])
            ids = pa.ListArray.from_arrays(pa.array(np.asarray(ends, np.int32)), pa.array(np.frombuffer(b"".join(flat), np.int32)))
            return {"doc_id": c["doc_id"], "n_pieces": np.diff(ends).tolist(), "score": scores, "n_best": n_best, "round_trip": whole, "ids": ids}
        return f

    return map_arrow(documents.select("doc_id", "text"), make, SCHEMA, rows=256, keeps=True)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_all(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
