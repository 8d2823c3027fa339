"""Lexical search and chunks over documents and provisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigora.functions.text import chunks, clean, tokens


def weighted_text(title: Column, *rest: Column) -> Column:
    """The text that is counted: the title twice, then the rest."""
    return F.concat_ws(" ", title, title, *rest)


def term_counts(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """key, term, tf: an inverted index."""
    return docs.select(key, F.explode(tokens(text)).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def records(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """docs with token_count and term_counts (map). Counted by term, then gathered by document: linear in the tokens, however long a text is."""
    maps = term_counts(docs, key, text).groupBy(F.col(key).alias("_k")).agg(F.sum("tf").alias("_n"), F.map_from_entries(F.collect_list(F.struct("term", "tf"))).alias("_m"))
    empty = F.map_from_entries(F.array().cast("array<struct<term: string, tf: bigint>>"))
    made = docs.join(maps, F.col(key) == F.col("_k"), "left")
    return made.select(*docs.columns, F.coalesce("_n", F.lit(0)).alias("token_count"), F.coalesce("_m", empty).alias("term_counts"))


def lexical_score(query: str, text: Column, title: Column, key: Column) -> Column:
    """Sum of term frequencies, +4 a query token in the title, +2 one in the id, +max(6, 3n) for the phrase in the text, +8 for it in the title; n tokens in the query. Repeated tokens count once as terms, each time as bonuses."""
    import re

    words = re.findall("[a-z0-9]+", query.lower())
    phrase = " ".join(query.lower().split())
    found = tokens(text)
    title, key, low = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(key.cast("string"), F.lit(""))), F.lower(clean(text))
    score = F.lit(0)
    if words:
        # Each term counts its frequency, so all of them together the tokens that are terms: one pass over the text.
        score = score + F.size(F.filter(found, lambda t: t.isin(*dict.fromkeys(words))))
    for w in words:
        score = score + F.when(F.contains(title, F.lit(w)), 4).otherwise(0) + F.when(F.contains(key, F.lit(w)), 2).otherwise(0)
    if phrase:
        score = score + F.when(F.contains(low, F.lit(phrase)), max(6, 3 * len(words))).otherwise(0) + F.when(F.contains(title, F.lit(phrase)), 8).otherwise(0)
    return score


def top_k(docs: DataFrame, score: Column, key: str, k: int, *extra: Column) -> DataFrame:
    """The k rows with the highest scores over 0; ties to the shorter, then smaller key. Each task keeps k rows."""
    return docs.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), *extra, key).limit(k)


def chunked(docs: DataFrame, key: str, text: str, max_chars: int = 900, overlap: int = 120) -> DataFrame:
    """chunk_id, key, chunk_index (from 1), text, token_estimate."""
    made = docs.select(key, F.posexplode(chunks(max_chars, overlap)(F.col(text))).alias("_i", "text"))
    index = F.col("_i") + 1
    return made.select(F.concat(F.col(key).cast("string"), F.lit("#chunk-"), F.lpad(index.cast("string"), 4, "0")).alias("chunk_id"), key, index.alias("chunk_index"), "text", F.greatest(F.lit(1), F.floor(F.length("text") / 4)).cast("int").alias("token_estimate"))


def best_of(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row a key, the first in the order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def remaining(chunks_: DataFrame, done: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """Chunks that are not embedded yet and have text: a resumable scan."""
    return chunks_.where(F.length(F.trim(F.coalesce(text, F.lit("")))) > 0).join(done.select(key).distinct(), key, "left_anti")


def matched(chunks_: DataFrame, vectors: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Chunks with their vectors; a chunk or a vector without partner ends the query with an error."""
    made = chunks_.withColumn("_c", F.lit(True)).join(vectors.withColumn("_v", F.lit(True)), key, "full_outer")
    return made.where(F.assert_true(F.col("_c") & F.col("_v"), F.lit("chunk and vector do not match")).isNull()).drop("_c", "_v")


#: Characters of passages that are broadcast together.
PASSAGE_CHARS = 16_000_000


def holding(docs: DataFrame, key: str, text: str, passages: DataFrame, passage: str) -> DataFrame:
    """Keys of the documents whose text holds any of the passages, letter for letter.

    One pass over the texts finds all passages of a block by an automaton; blocks
    have about ``PASSAGE_CHARS`` characters, so a broadcast is bounded however
    many passages there are. Null and empty passages are held by none.
    """
    import math

    rows = passages.select(F.col(passage).alias("p")).where(F.length("p") > 0).distinct()
    blocks = max(1, math.ceil((rows.agg(F.sum(F.length("p"))).first()[0] or 0) / PASSAGE_CHARS))
    spark, found = docs.sparkSession, None
    for k in range(blocks):
        shared = spark.sparkContext.broadcast([r.p for r in rows.where(F.pmod(F.xxhash64("p"), F.lit(blocks)) == k).collect()])

        def run(batches, shared=shared):
            import ahocorasick
            import pyarrow as pa

            held = ahocorasick.Automaton()
            for p in shared.value:
                held.add_word(p, len(p))
            held.make_automaton()
            for batch in batches:
                hit = [bool(t) and len(held) > 0 and next(held.iter(t), None) is not None for t in batch.column(1).to_pylist()]
                yield batch.select([0]).filter(pa.array(hit, pa.bool_()))

        made = docs.select(key, text).mapInArrow(run, docs.select(key).schema)
        found = made if found is None else found.unionByName(made)
    return found.distinct()
