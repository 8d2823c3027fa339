"""Token counts by prefix dynamic programming over byte-pair encodings.

For each piece of the pre-tokeniser's split, ``last[i]`` is the last token of
the encoding of the piece's first i bytes and ``count[i] = count[i - len(last[i])] + 1``:
an encoding is right exactly if each two neighbours in it are what the merges
give for the two together, so the one token that fits its predecessor is found
among the tokens that end at i. The counts of all prefixes answer how many
tokens a truncated text has and where a budget ends, without encoding again.

A blank begins a piece unless it stands inside a run of white space, so texts
are cut at blanks, and the counts of the words between them are remembered by
a worker for all its tasks.

Defined results: null texts count as empty (0 tokens, 0 bytes); special strings
in a text count as one token, as the library does by default; very long texts
and very long words are counted whole, in time linear in their length; an empty
table gives no rows; repeated rows and ids each get their row; other columns,
whatever their names, are left out.
"""

from __future__ import annotations

import functools
import json
import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from vigora.llm.common import Remembered, map_arrow, table
from vigora.llm.tries import Table, Trie

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as the pattern's library has it (not as Python's str has it).
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: A blank inside a run of white space, which begins no piece.
INNER = rf" (?<=[{WHITE}] )(?=[{WHITE}]|\Z)"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Bounds on memory: words and pieces remembered by a worker (twice as many at most), token pairs, and the length of a remembered word.
MAX_WORDS, MAX_PIECES, MAX_PAIRS, MAX_WORD = 600_000, 500_000, 500_000, 64
LIMIT = 1024


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins for bytes that byte-level vocabularies are written in."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class PrefixCounter:
    """Exact token counts of texts and of all their prefixes, for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in _byte_alphabet().items()}
        raw = lambda s: bytes(back[c] for c in s)
        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if all(c in back for c in s)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        # Tokens are numbers here; each has the rank of the merge that makes it (-1: a byte) and its two parts.
        self.shift = max(self.ids.values()).bit_length()
        self.rank, self.made, self.halves = {}, dict.fromkeys(self.ids.values(), -1), {}
        for k, (a, b) in enumerate(merges):
            a, b = raw(a), raw(b)
            if a + b in self.ids:
                x, y, whole = self.ids[a], self.ids[b], self.ids[a + b]
                self.rank[x << self.shift | y] = k
                if whole not in self.halves:
                    self.made[whole], self.halves[whole] = k, (x, y)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.split, self.inner, self.outer = regex.compile(PATTERN).findall, re.compile(INNER).search, re.compile(f"(?!{INNER}) ").split
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")").split
        self.pairs: dict[int, bool] = {}
        self.long: tuple[bytes, list[int]] = b"", [0]
        #: Sizes of pieces, and of words with a blank before them.
        self.pieces, self.words = Remembered(self._piece, MAX_PIECES, MAX_WORD), Remembered(self._word, MAX_WORDS, MAX_WORD)
        # A token is usable if the merges build it from its own bytes. Bytes are handled as Latin-1 strings.
        self.ending = ahocorasick.Automaton()
        for token, i in self.ids.items():
            if len(token) == 1 or i in self.halves:
                self.ending.add_word(token.decode("latin-1"), (len(token), i))
        self.ending.make_automaton()
        self.trie = Trie([(token.decode("latin-1"), i) for token, i in self.ids.items() if len(token) == 1 or i in self.halves])
        #: The pairs that were asked for by arrays, as a table of 0 and 1.
        self.checked = Table(most=MAX_PAIRS)

    def fits(self, pair: int) -> bool:
        """Whether two tokens stay two when the merges are run on their bytes.

        The merges at the boundary are undone, latest first; tokens that then
        meet there must not have a merge that comes before the one undone. Of
        equal merges the left one comes first.
        """
        a, b, before, rank, made, halves = pair >> self.shift, pair & (1 << self.shift) - 1, 1 << 60, self.rank.get, self.made, self.halves
        ok = None
        while ok is None:
            if rank(a << self.shift | b, before) < before:
                ok = False
            elif made[a] > made[b]:
                before, a = made[a], halves[a][1]
            elif made[b] >= 0:
                before, b = made[b] + 1, halves[b][0]
            else:
                ok = True
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        self.pairs[pair] = ok
        return ok

    def prefixes(self, piece: bytes) -> list[int]:
        """count[i]: tokens of the first i bytes of one piece, for each i; those of the last long piece are kept."""
        if len(piece) <= MAX_WORD:
            return self._prefixes(piece)
        if self.long[0] != piece:
            self.long = piece, self._prefixes(piece)
        return self.long[1]

    def _prefixes(self, piece: bytes) -> list[int]:
        known, fits, shift = self.pairs.get, self.fits, self.shift
        last = [0] * (len(piece) + 1)
        count = [0] * (len(piece) + 1)
        for end, (length, token) in self.ending.iter(piece.decode("latin-1")):
            end += 1
            if not count[end]:
                at = end - length
                if not at or (fits(pair) if (ok := known(pair := last[at] << shift | token)) is None else ok):
                    last[end], count[end] = token, count[at] + 1
        return count

    def _fit(self, pairs: np.ndarray) -> np.ndarray:
        """``fits`` for an array."""
        found = self.checked.get(pairs)
        if len(unknown := np.unique(pairs[found < 0])):
            if self.checked.n + len(unknown) > MAX_PAIRS:
                self.checked = Table(most=max(MAX_PAIRS, len(unknown)))
            self.checked.add(unknown, np.fromiter(map(self.fits, unknown.tolist()), np.int32, len(unknown)))
            return self._fit(pairs) if self.checked.n > len(unknown) else np.fromiter(map(self.fits, pairs.tolist()), bool, len(pairs))
        return found > 0

    def lengths(self, pieces: list[str]) -> list[int]:
        """Tokens of many pieces: the prefix tables of all of them are filled side by side."""
        lengths, bounds, places, ends, tokens = self.trie.matches([p.encode("utf-8", "surrogatepass").decode("latin-1") for p in pieces])
        begin = np.cumsum(lengths + 1) - lengths - 1
        size = int((lengths + 1).sum())
        last, count, first, bounds = np.zeros(size, np.int64), np.zeros(size, np.int32), np.zeros(size, bool), bounds.tolist()
        first[begin] = True
        for a, b in zip(bounds, bounds[1:]):
            start, end, token = places[a:b], ends[a:b], tokens[a:b]
            if not first[start[0]]:
                ok = self._fit(last[start] << self.shift | token)
                start, end, token = start[ok], end[ok], token[ok]
            last[end], count[end] = token, count[start] + 1
        return count[begin + lengths].tolist()

    def learn(self, words: set[str]) -> None:
        """Fills the memory for many words at once."""
        def ask(new: list[str]) -> list[int]:
            split = []
            # Letters, then ASCII marks or nothing: each one piece.
            for w in new:
                letters = w.rstrip(MARKS)
                split.append(((" " + letters, w[len(letters) :]) if len(letters) < len(w) else (" " + letters,)) if letters.isalpha() else self.split(" " + w))
            self.pieces.learn(set().union(*split), self.lengths)
            return [sum(map(self.pieces.__getitem__, p)) for p in split]

        self.words.learn(words, ask)

    def _piece(self, piece: str) -> int:
        return self.prefixes(piece.encode("utf-8", "surrogatepass"))[-1]

    def _word(self, word: str) -> int:
        return sum(map(self.pieces.__getitem__, self.split(" " + word)))

    def segments(self, text: str) -> list[str]:
        """Ordinary strings at even places, special ones at odd places."""
        return self.special(text) if any(s in text for s in self.specials) else [text]

    def cut(self, text: str) -> list[str]:
        """The words of an ordinary string; all but the first stand for themselves and a blank before them."""
        return self.outer(text) if self.inner(text) else text.split(" ")

    def sizes(self, words: list[str]) -> list[int]:
        """Tokens of what ``cut`` gives."""
        sizes = list(map(self.words.__getitem__, words))
        sizes[0] = sum(map(self.pieces.__getitem__, self.split(words[0])))
        return sizes

    def parts(self, text: str | None) -> list[tuple[list[str], list[int]]]:
        """Words and their tokens of each segment; every second one is a special string."""
        return [([s], [1]) if k % 2 else (words := self.cut(s), self.sizes(words)) for k, s in enumerate(self.segments(text))] if text else []

    def count(self, text: str | None) -> int:
        return sum(sum(sizes) for _, sizes in self.parts(text))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter a worker, with all that it remembers."""
    return PrefixCounter(path)


class PrefixTable:
    """The token count at every prefix of one text: sums over whole words, and the prefix counts of each piece that is asked for, kept."""

    def __init__(self, counter: PrefixCounter, text: str, parts: list[tuple[list[str], list[int]]] | None = None):
        self.counter, self.text = counter, text
        #: Of each word or special string: where it starts, the tokens before it, whether it is special, whether a segment begins with it.
        starts, sums, self.special, self.first = [0], [0], [], []
        for k, (words, sizes) in enumerate(counter.parts(text) if parts is None else parts):
            lengths = [len(w) + 1 for w in words]
            lengths[0] -= 1
            starts += accumulate(lengths, initial=starts.pop())
            sums += accumulate(sizes, initial=sums.pop())
            self.special += [bool(k % 2)] * len(words)
            self.first += [True] + [False] * (len(words) - 1)
        self.starts, self.sums = starts, sums
        self.kept: dict[int, list[int]] = {}

    def _characters(self, piece: str) -> list[int]:
        """Tokens of the first i characters of one piece, for each i."""
        counts, sizes = self.counter.prefixes(piece.encode("utf-8", "surrogatepass")), (len(c.encode("utf-8", "surrogatepass")) for c in piece)
        return [counts[i] for i in accumulate(sizes, initial=0)]

    def inside(self, k: int) -> list[int]:
        """Tokens of the text up to each character of word ``k``, from its start to its end.

        A piece cut short is one piece still, with two exceptions: white space
        at the cut is one piece with all white space before it, and of a
        contraction each cut leaves the apostrophe and the letters apart.
        """
        if (found := self.kept.get(k)) is not None:
            return found
        word, out = self.text[self.starts[k] : self.starts[k + 1]], [self.sums[k]]
        if self.special[k]:
            # A part of a special string is ordinary text and may join what stands before it.
            back = k
            while back and not self.special[back - 1] and (back == k or not self.counter.cut(self.text[self.starts[back] : self.starts[k]])[0]):
                back -= 1
            begin, before = self.starts[back], self.sums[back]
            whole = [self.counter.count(self.text[begin : self.starts[k] + i]) for i in range(1, len(word))]
            out += [before + n for n in whole] + [self.sums[k] + 1]
        else:
            for piece in self.counter.split(word):
                before = out[-1]
                if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():
                    parts = accumulate(map(self.counter.pieces.__getitem__, piece))
                    out += [before + n for n in parts]
                    out[-1] = before + self.counter.pieces[piece]
                else:
                    out += [before + n for n in self._characters(piece)[1:]]
            self._white(k, word, out)
        self.kept[k] = out
        return out

    def _white(self, k: int, word: str, out: list[int]) -> None:
        """Where a prefix ends in white space, all of that is one piece: its counts come from the whole run."""
        i = 0
        while i < len(word):
            if not word[i] in WHITE:
                i += 1
                continue
            end = i
            while end < len(word) and word[end] in WHITE:
                end += 1
            begin, at, base = self.starts[k] + i, k, out[i]
            if not i:
                # The run may have begun in the words before, up to the segment's start.
                while begin and self.text[begin - 1] in WHITE and not self.first[at]:
                    at -= 1
                    piece = self.text[self.starts[at] : self.starts[k]]
                    begin = self.starts[at] + len(piece.rstrip(WHITE))
                    base = self.sums[at] if begin == self.starts[at] else self.inside(at)[begin - self.starts[at]]
                    if begin > self.starts[at]:
                        break
            counts = self._characters(self.text[begin : self.starts[k] + end])
            skip = self.starts[k] + i - begin
            for j in range(1, end - i + 1):
                out[i + j] = base + counts[skip + j]
            i = end

    def at(self, n_chars: int) -> int:
        """Tokens of the first ``n_chars`` characters."""
        n_chars = max(0, min(n_chars, len(self.text)))
        if not n_chars:
            return 0
        k = min(bisect_right(self.starts, n_chars), len(self.starts) - 1) - 1
        return self.inside(k)[n_chars - self.starts[k]]

    def truncate(self, budget: int) -> int:
        """The most leading characters that have ``budget`` tokens or fewer."""
        if self.sums[-1] <= budget:
            return len(self.text)
        # Only white space before it can make the word after next fit.
        k = bisect_right(self.sums, budget) - 1
        for word in range(min(k + 2, len(self.special) - 1), -1, -1):
            counts = self.inside(word)
            for i in range(len(counts) - 1, 0, -1):
                if counts[i] <= budget:
                    return self.starts[word] + i
        return 0


def count_tokens(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (leading characters within the limit); one row for each row, no shuffle."""

    def make():
        count = counter(path)

        def f(c):
            texts = [t or "" for t in c["text"]]
            n, fit = [], []
            count.learn(set().union(*(t.split(" ") for t in texts)))
            for t in texts:
                parts = count.parts(t)
                n.append(sum(sum(sizes) for _, sizes in parts))
                # Each word but a segment's first has a token: the first words hold the place where the limit is met.
                head = [(w[: limit + 4], x[: limit + 4]) for w, x in parts[:1]] if len(parts) == 1 else parts
                fit.append(PrefixTable(count, t, head).truncate(limit) if n[-1] > limit else len(t))
            return {
                "doc_id": c["doc_id"], "n_bytes": pc.fill_null(pc.binary_length(pa.array(texts, pa.large_string())), 0).cast(pa.int64()), "n_tokens": n, "over_limit": [x > limit for x in n],
                "fit_chars": fit,
            }
        return f

    return map_arrow(documents.select("doc_id", "text"), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
