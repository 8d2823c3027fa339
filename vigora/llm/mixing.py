"""Mixing sources to target weights by temperature, in DataFrame operations only.

A source with the share p of all tokens gets the weight p^a / sum(p^a). The
exponent a is bisected: from 0 (all sources alike) to 1 (as they are) it is the
least one whose weights hold the limit on repeats and have an entropy of at most
the target; for an entropy under the sources' own it goes on above 1. Both limits
hold, or an error says which cannot: a budget needs as many repeats as it has
times the tokens there are, and over 1 the largest source is repeated. The limit
is on a source's tokens; a single row is repeated at most the next whole number of
times. Each step evaluates a row of exponents in one small aggregate.

The budget is then realised by blocks: a document's hash puts it in one of
``2 ** BLOCKS_LOG2`` blocks of its source. A source gets whole passes, and in the
last pass its blocks in a permuted order until its part of the budget is used; the
block where it ends is cut into as many blocks again, by more bits of the hash, and
in the last of these documents are taken by their hashes. So only a row for each
source and block is ever summed up, and no source is sorted or gathered.

Defined results: a null source is a source of its own; null or empty texts have
0 tokens and follow their block; rows with the same id share their fate; empty
input gives no rows; very long texts count whole; a source without tokens has
weight 0 and is left out; other columns, whatever their names, are kept in _row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigora.llm.common import WORDS, checkpointed, table

BLOCKS_LOG2 = 10
POINTS, PASSES, SHARPEST = 24, 5, 16.0
#: Sources whose decisions may be broadcast (some 100 bytes each).
MAX_BROADCAST = 20_000
MAX_REPEATS, BLOCK_TOKENS, SEED = 1.25, 1_000_000, 20


def _tokens():
    return F.coalesce(F.regexp_count("_row.text", F.lit(WORDS)), F.lit(0)).cast("long")


def _keyed(documents: DataFrame, seed: int) -> DataFrame:
    """_row (the whole row, so that no column's name can clash), _source, _h (hash of the id), _block (its first bits)."""
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    source = F.coalesce(F.concat(F.lit("s"), F.col("_row.source").cast("string")), F.lit("-"))
    return rows.select("_row", source.alias("_source"), F.xxhash64("_row.doc_id", F.lit(seed)).alias("_h")).withColumn("_block", F.shiftrightunsigned("_h", 64 - BLOCKS_LOG2))


def _measures(sources: DataFrame, exponents: list[float], top: float) -> list[tuple[float, float]]:
    """For each exponent: entropy of the weights; the most repeated source's repeats for a budget of one token."""
    x = F.col("lt") - F.lit(top)
    cols = []
    for k, a in enumerate(exponents):
        e = F.exp(a * x)
        cols += [F.sum(e).alias(f"z{k}"), F.sum(a * x * e).alias(f"y{k}"), F.max(F.exp(a * x - F.col("lt"))).alias(f"r{k}")]
    row = sources.agg(*cols).first()
    return [(math.log(row[f"z{k}"]) - row[f"y{k}"] / row[f"z{k}"], row[f"r{k}"] / row[f"z{k}"]) for k in range(len(exponents))]


def exponent(sources: DataFrame, budget: float, target_entropy: float | None, max_repeats: float | None) -> tuple[float, float, float]:
    """(exponent, log of the weights' normaliser, largest log count); sources: lt, the log of its tokens.

    The least exponent whose weights hold the limit on repeats and have an
    entropy of at most the target; an error if there is none.
    """
    top = sources.agg(F.max("lt")).first()[0]

    def least(met, low: float, high: float) -> float:
        """The least exponent from which ``met`` holds; it does at ``high``."""
        for _ in range(PASSES):
            grid = [low + (high - low) * (k + 1) / (POINTS + 1) for k in range(POINTS)]
            good = [k for k, m in enumerate(_measures(sources, grid, top)) if met(*m)]
            k = good[0] if good else POINTS
            low, high = (grid[k - 1] if k else low), (grid[k] if k < POINTS else high)
        return high

    flat, own, sharp = _measures(sources, [0.0, 1.0, SHARPEST], top)
    holds = lambda entropy, repeats: max_repeats is None or repeats * budget <= max_repeats * (1 + 1e-9)
    under = lambda entropy, repeats: target_entropy is None or entropy <= target_entropy
    if not holds(*own):
        raise ValueError(f"a budget of {budget} tokens repeats the sources {own[1] * budget:.4g} times at least; the limit is {max_repeats}")
    if not under(*sharp):
        raise ValueError(f"no exponent gives an entropy of {target_entropy}; the least is {sharp[0]:.4g}")
    high = 0.0 if holds(*flat) else least(holds, 0.0, 1.0)
    if not under(*flat):
        high = max(high, least(under, 0.0, 1.0) if under(*own) else least(under, 1.0, SHARPEST))
    (entropy, repeats), = _measures(sources, [high], top)
    if not holds(entropy, repeats):
        raise ValueError(f"an entropy of {target_entropy} repeats the largest source {repeats * budget:.4g} times; the limit is {max_repeats}")
    z = sources.agg(F.sum(F.exp(high * (F.col("lt") - top)))).first()[0]
    return high, math.log(z), top


def mix(documents: DataFrame, budget: int | None = None, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """_row (a row of ``documents``), tokens, copy (from 1), weight, mix_block (a block of the mixture has its sources by weight); each row as often as its source's weight asks.

    budget: tokens to realise; all that there are, if None. No source gets more than its part.
    """
    keyed = _keyed(documents, seed)
    perm = F.xxhash64("_source", "_block", F.lit(seed + 1))
    blocks = checkpointed(keyed.groupBy("_source", "_block").agg(F.sum(_tokens()).alias("tokens")).where("tokens > 0"))
    sources = blocks.groupBy("_source").agg(F.sum("tokens").alias("tokens")).withColumn("lt", F.log("tokens"))
    sources = checkpointed(sources)
    n_sources, total = sources.agg(F.count("*"), F.sum("tokens")).first()
    if not n_sources:
        return keyed.select("_row", F.lit(0).cast("long").alias("tokens"), F.lit(1).alias("copy"), F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("mix_block")).limit(0)
    budget = total if budget is None else budget
    a, z, top = exponent(sources, budget, target_entropy, max_repeats)
    wanted = sources.withColumn("weight", F.exp(a * (F.col("lt") - top) - z)).withColumn("passes", F.col("weight") * budget / F.col("tokens"))
    wanted = wanted.select("_source", "weight", F.floor(F.col("passes") + 1e-9).alias("full"), ((F.col("passes") - F.floor(F.col("passes") + 1e-9)) * F.col("tokens")).alias("rest"))
    # Blocks in permuted order until the rest is used: at most 2 ** BLOCKS_LOG2 rows a source.
    running = Window.partitionBy("_source").orderBy("perm").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        blocks.withColumn("perm", perm).join(wanted, "_source").withColumn("cum", F.sum("tokens").over(running))
        .where(F.col("cum") > F.col("rest"))
        .groupBy("_source").agg(F.min(F.struct("perm", "_block", (F.col("rest") - F.col("cum") + F.col("tokens")).alias("left"))).alias("b"))
        .select("_source", "b.*")
    )
    plan = checkpointed(wanted.join(last, "_source", "left"))
    small = n_sources <= MAX_BROADCAST
    hint = F.broadcast if small else (lambda d: d)
    # The block where a source ends is cut by the next bits of the hash, in their order, until what is left is used.
    finer = F.shiftrightunsigned(F.shiftleft("_h", BLOCKS_LOG2), 64 - BLOCKS_LOG2)
    inside = keyed.join(hint(plan.select("_source", "_block", "left")), ["_source", "_block"]).withColumn("_part", finer)
    so_far = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    cut = checkpointed(
        inside.groupBy("_source", "_block", "left", "_part").agg(F.sum(_tokens()).alias("tokens")).withColumn("cum", F.sum("tokens").over(so_far))
        .where(F.col("cum") > F.col("left")).groupBy("_source", "_block").agg(F.min(F.struct("_part", (F.col("left") - F.col("cum") + F.col("tokens")).alias("left"))).alias("p"))
        .select("_source", "_block", F.col("p._part").alias("_part"), F.col("p.left").alias("left"))
    )
    # In the last part, 2 ** -20 of a source, documents by their hashes.
    within = Window.partitionBy("_source").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        keyed.withColumn("_part", finer).join(hint(cut), ["_source", "_block", "_part"])
        .groupBy("_source", "_h", "left").agg(F.sum(_tokens()).alias("tokens"))
        .withColumn("cum", F.sum("tokens").over(within)).where(F.col("cum") <= F.col("left"))
        .groupBy("_source").agg(F.max("_h").alias("cut"))
    )
    parts = cut.select("_source", F.col("_part").alias("_last")).join(ends, "_source", "left")
    decisions = checkpointed(plan.select("_source", "weight", "full", "perm", "_block").withColumnRenamed("_block", "_end").join(parts, "_source", "left"))
    before = F.coalesce(perm < F.col("perm"), F.lit(True))
    final = (finer < F.col("_last")) | ((finer == F.col("_last")) & F.coalesce(F.col("_h") <= F.col("cut"), F.lit(False)))
    part = F.when(F.col("_block") == F.col("_end"), F.coalesce(final, F.lit(True))).otherwise(before & F.col("perm").isNotNull())
    n_blocks = max(1, math.ceil(budget / BLOCK_TOKENS))
    return (
        keyed.join(hint(decisions), "_source").withColumn("_copies", (F.col("full") + part.cast("int")).cast("int")).where("_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("_row", _tokens().alias("tokens"), "copy", "weight", F.pmod(F.xxhash64("_row.doc_id", "copy", F.lit(seed + 2)), F.lit(n_blocks)).cast("long").alias("mix_block"))
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return made.select("_row.doc_id", "_row.source", F.col("tokens").alias("n_tokens"), "copy", "weight", "mix_block")
