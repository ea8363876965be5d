"""A training corpus in five stages, each an operator of ``ledgerproof.llm`` over all documents.

Language identification, exact deduplication, near-duplicate removal, mixing of sources to
target weights, piece encoding. Each stage gets what the one before it kept, and all but the
last return the columns of documents. Every stage takes nulls, empty texts and empty tables
as its operator's docstring says.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm import dartminhash, hyperlang, mixing, pieces, radix
from ledgerproof.llm.common import drop_settled, mod_hash, settle, settled, table

# A score of two standard deviations of what unrelated vectors have: no language at all.
LEAST_SCORE = 2 / hyperlang.DIM**0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_spent: list[str] = []


def stage(f: Stage) -> Stage:
    """A stage that first drops the working tables of the stages before it.

    Their results have been written by then, so nothing reads those tables any more.
    """

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_settled(spark, [p for p in _spent if p in settled()])
        before = set(settled())
        out = f(spark, docs, sf_dir)
        _spent[:] = [p for p in settled() if p not in before]
        return out

    return run_stage


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that are like no known language."""
    profiles = hyperlang.learn(docs, mod_hash("doc_id", 3) != 1)
    found = hyperlang.identify(docs, profiles, carry=docs.columns)
    known = (F.col("lang_pred") != hyperlang.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    # Without any labelled text there is no language to reject by.
    return found.where(known).select("row.*") if profiles else docs


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return radix.without_copies(docs)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return dartminhash.without_near_duplicates(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, by weights 1, 2, 3, repeating."""
    return mixing.mixed_documents(docs)


@stage
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, round_trip of every row."""
    return pieces.encode(docs, pieces.read_pieces())


STAGES = [
    ("language", identify_language),
    ("exact copies", drop_copies),
    ("near copies", drop_near_duplicates),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]
# Learned profiles, signatures and merges have no SQL; the tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs, read = table(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        before = set(settled())
        docs = settle(step(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        drop_settled(spark, read)
        read = [p for p in settled() if p not in before and p not in _spent]
    return STAGES[-1][1](spark, docs, sf_dir)
