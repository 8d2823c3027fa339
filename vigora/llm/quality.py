"""Quality rules: compression bands over whole texts and fixed chunks.

A text is rejected if the ratio of its bytes to its zstandard-compressed bytes
leaves the band for its length: above it, it repeats itself or follows a
pattern; under it, it is noise. The limits are interpolated over the logarithm
of the length, for longer prose always compresses better. Fixed chunks of
``CHUNK`` bytes, the last one shorter, are held against the band for their own
length, so that a repetitive or random part is seen in a long text as well: a
text goes if over ``BAD_SHARE`` of its chunks leave the band.

Defined results: null and empty texts have no words, ratio 0, and fail the base
rules; texts under ``LEAST_BYTES`` are not judged by ratio (the frame alone
outweighs them); very long texts are judged whole, over the longest of ``BANDS``
by its limits; a ratio just at a limit is within it; each repeated row or id is
judged for itself; an empty table gives no rows; other columns, whatever their
names, are kept by ``keep_good`` alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from vigora.llm.common import WORDS, keep_texts, map_arrow, table

#: Bytes of a text, least and most ratio; between them by linear interpolation over log2 of the bytes.
BANDS = ((100, 0.80, 1.50), (200, 1.00, 1.68), (400, 1.10, 1.84), (800, 1.25, 2.02), (1600, 1.35, 2.155), (3200, 1.40, 2.265), (6400, 1.45, 2.36), (12800, 1.50, 2.47), (25600, 1.50, 2.62), (102400, 1.50, 3.0), (1_638_400, 1.50, 4.0))
CHUNK, BAD_SHARE, LEAST_BYTES, LEVEL = 4096, 0.05, 100, 3
FIND, SYMBOLS = re.compile(WORDS), re.compile(r"[#*$%&|<>]")


def band(n_bytes: int) -> tuple[float, float]:
    """The least and most ratio for a text of so many bytes."""
    x = math.log2(min(max(n_bytes, BANDS[0][0]), BANDS[-1][0]))
    for (a, la, ha), (b, lb, hb) in zip(BANDS, BANDS[1:]):
        if x <= math.log2(b):
            t = (x - math.log2(a)) / (math.log2(b) - math.log2(a))
            return la + t * (lb - la), ha + t * (hb - ha)
    return BANDS[-1][1:]


def repeated_words(words: list[str]) -> int:
    """Words that stand in a five-word window found twice or more in the text, first included."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, total, end = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            total += at + 5 - max(at, end)
            end = at + 5
    return total


def compressions(data: bytes, compress) -> tuple[float, int, int]:
    """Ratio of the whole, chunks out of their band, chunks judged (those of LEAST_BYTES at least)."""
    if not data:
        return 0.0, 0, 0
    size = len(compress(data))
    bad = judged = 0
    if len(data) > CHUNK:
        for at in range(0, len(data), CHUNK):
            part = data[at : at + CHUNK]
            if len(part) >= LEAST_BYTES:
                low, high = band(len(part))
                judged += 1
                bad += not low <= len(part) / len(compress(part)) <= high
    return len(data) / size, bad, judged


def judge(text: str | None, compress) -> dict:
    text = text or ""
    words = FIND.findall(text)
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if FIND.search(line):
            dup_lines += line in seen
            seen.add(line)
    n, repeated = len(words), repeated_words(words)
    failed = n < 10 or 100 * repeated > 20 * n
    data = text.encode("utf-8", "surrogatepass")
    ratio, bad, judged = compressions(data, compress)
    low, high = band(len(data))
    verdict = len(data) < LEAST_BYTES or low <= ratio <= high and bad <= BAD_SHARE * judged
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(SYMBOLS.findall(text)), "n_dup_lines": dup_lines, "n_repeat_words": repeated, "base_failed": failed, "kept": not failed and verdict, "ratio": ratio, "bad_chunks": bad, "n_chunks": judged}


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, bad_chunks long, n_chunks long"


def _compressor():
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL).compress


def judge_all(documents: DataFrame) -> DataFrame:
    """A row of counts and the verdict for each row; no shuffle."""

    def make():
        compress = _compressor()

        def f(c):
            made = [judge(t, compress) for t in c["text"]]
            return {"doc_id": c["doc_id"]} | {k: [m[k] for m in made] for k in (made[0] if made else [])}
        return f

    return map_arrow(documents.select("doc_id", "text"), make, SCHEMA)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_all(table(spark, sf_dir, "documents"))


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are kept, with their columns."""

    def make():
        compress = _compressor()
        return lambda text: judge(text, compress)["kept"]

    return keep_texts(documents, make)
