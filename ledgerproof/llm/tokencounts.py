"""Exact length histogram of the encoded documents, and what follows from its suffix sums.

Each text is encoded whole; only its length is kept and only the histogram (documents by
length) leaves the tasks. Sums over all lengths from ``n`` on then answer, for every
context limit, how many documents reach it, how many tokens remain if all texts are cut
there, and every quantile. The histogram is written once, so that no text is encoded twice. The suffix sums are taken in runs of ``RUN`` lengths and over
the runs, so that no task sorts more than the runs or one run.

A very long run of blanks would exhaust the stack of the vocabulary's pattern; texts are cut
around such runs, where the pattern itself cuts: a run is one part, but for its last blank if
something follows.

Cases: null and empty texts have 0 tokens; very long texts are encoded like others; an empty table gives an empty histogram, sums
of 0 and no quantile; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerproof.llm.common import settle, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's texts are cut before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RUN = 256
# Runs of blanks (as the pattern has them) of this length are taken out of the pattern's hands.
LONG_RUN = 5000
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token ranks from a vocabulary file; the driver reads it, tasks get its content."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def parts_of(text: str) -> Iterator[tuple[bool, str]]:
    """The text in pieces that are encoded each; True for a long run of blanks, which is one part."""
    at = 0
    for run in BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield False, text[at : run.start()]
        yield True, text[run.start() : end]
        at = end
    yield False, text[at:]


def lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens of every document."""
    spark: SparkSession = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={})
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n: list[int] = []
            for part in slices([len(t) for t in texts]):
                plain = [t if len(t) < LONG_RUN or not BLANKS.search(t) else "" for t in texts[part]]
                found = [len(x) for x in encoding.encode_ordinary_batch(plain, num_threads=1)]
                for i, text in enumerate(texts[part]):
                    if text and not plain[i]:
                        runs = [(encoding._encode_single_piece if run else encoding.encode_ordinary)(p) for run, p in parts_of(text) if p]
                        found[i] = sum(map(len, runs))
                n += found
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(count, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """Per occurring length: docs, tokens, and both summed over this length and all longer ones.

    Also truncated_total, the tokens that remain if every text is cut to this length, and
    share, the part of the documents that are no longer than it.
    """
    lengths_ = counted.groupBy("n_tokens").agg(F.count("*").alias("docs"))
    lengths_ = settle(lengths_.withColumn("tokens", F.col("n_tokens") * F.col("docs")), "token-histogram")
    lengths_ = lengths_.withColumn("run", F.expr(f"n_tokens div {RUN}"))
    runs = lengths_.groupBy("run").agg(F.sum("docs").alias("run_docs"), F.sum("tokens").alias("run_tokens"))
    later = Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = runs.select(
        "run",
        F.coalesce(F.sum("run_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("run_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("run_docs").over(all_).alias("all_docs"),
        F.sum("run_tokens").over(all_).alias("all_tokens"),
    )
    within = Window.partitionBy("run").orderBy(F.desc("n_tokens"))
    at_least = F.col("later_docs") + F.sum("docs").over(within)
    tokens_at_least = F.col("later_tokens") + F.sum("tokens").over(within)
    return (
        lengths_.join(runs, "run")
        .withColumns({"docs_at_least": at_least, "tokens_at_least": tokens_at_least})
        .select(
            "n_tokens",
            "docs",
            "tokens",
            "docs_at_least",
            "tokens_at_least",
            F.expr("n_tokens * docs_at_least + all_tokens - tokens_at_least").alias("truncated_total"),
            F.expr("(all_docs - docs_at_least + docs) / all_docs").alias("share"),
        )
    )


def truncated_totals(table: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For any context limits: documents longer than it, and tokens left after cutting there."""
    spark = table.sparkSession
    wanted = spark.createDataFrame([(int(n),) for n in limits], "limit long")
    # One row per stated limit and histogram length; the limits are a short literal list.
    pairs = table.select("n_tokens", "docs_at_least", "tokens_at_least").withColumn(
        "limit", F.explode(F.array(*(F.lit(int(n)).cast("long") for n in limits)))
    )
    # The sums from the first longer length on; those from the first length of all are the totals.
    longer = F.when(F.col("n_tokens") > F.col("limit"), F.col("n_tokens"))
    sums = pairs.groupBy("limit").agg(
        F.max("tokens_at_least").alias("total"),
        F.coalesce(F.min_by("docs_at_least", longer), F.lit(0)).alias("docs_longer"),
        F.coalesce(F.min_by("tokens_at_least", longer), F.lit(0)).alias("tokens_longer"),
    )
    left = F.expr("total - tokens_longer + limit * docs_longer").alias("tokens_left")
    return wanted.join(sums.select("limit", "docs_longer", left), "limit", "left").na.fill(0)


def quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """For each share the smallest length that at least so many documents do not exceed."""
    pairs = table.withColumn("q", F.explode(F.array(*(F.lit(float(s)) for s in shares))))
    return pairs.where("share >= q").groupBy("q").agg(F.min("n_tokens").alias("n_tokens"))
