"""From raw documents to encoded training rows: toxicity, quality, near-duplicates, mixing, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.

Defined results, as the operators' own: null and empty texts are not toxic, but
fail the quality stage; very long texts are handled whole; of rows with one id,
or alike in five-word shingles, the near-duplicate stage keeps one, that of the
least id; rows without an id have no copies and stay; a null source is mixed as
a source of its own; columns beside doc_id, text and source are carried along;
an empty table gives no rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from vigora.llm import mixing, neardup, pieces, quality, toxicity
from vigora.llm.common import checkpointed, give_back, table

#: Words in a shingle of the near-duplicate stage.
SHINGLE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold the base rules and their compression bands."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the least id."""
    return neardup.keep_one(docs, SHINGLE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as its source's weight in the mixture asks."""
    return mixing.mix(docs).select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row."""
    import public_tokenizers

    return pieces.encode_all(docs, public_tokenizers.path("piece_bpe_32k.model"))


def _relieved(stage):
    """``stage``, begun when the driver and the executors have given back what the stage before it left."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        give_back(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [(name, _relieved(stage)) for name, stage in (
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("neardup", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", encode),
)]

#: SQL cannot express the learned and hashed stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
