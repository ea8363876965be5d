"""Exact deduplication by most-significant-digit radix partitioning.

Documents are split by their first bytes, every group by its next bytes, and so on, until
a group is a single document or its texts have ended: what is left together is equal. No
digest takes part in the comparison. A digit is a run of bytes, 64 at first and four times
as many in each further round, so that even very long copies need few rounds. A document
leaves as soon as it is alone, and only the texts of open groups move on.

Groups are counted with map-side aggregates and joined back to the rows, so a group that
holds a third of all rows is a counted key of a splittable join and not one task's load.

Cases: a null text counts as empty, and all empty texts are equal; a null id is smaller than
every other; rows that share both id and text are one document, and all of them are marked
kept; an empty table gives an empty result; other columns are only carried, in a struct.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerproof.llm.common import ascii_lower, packed, settle

FIRST_DIGIT = 64
GROWTH = 4


def copies(
    docs: DataFrame, *, first_digit: int = FIRST_DIGIT, carry: Sequence[str] = (), only_kept: bool = False
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, and ``row``.

    Texts are equal when identical after lower-casing A-Z; the row with the largest id of a
    group stays. ``row`` is a struct of the carried columns; with ``only_kept`` it is NULL in
    rows that go.
    """
    text = ascii_lower(F.coalesce("text", F.lit("")))
    state = docs.select(
        F.lit(0).cast("long").alias("group"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(text, 256).alias("text_sha256"),
        packed(docs, carry or ["text"]),
        *([] if not carry or "text" in carry else [F.col("text").alias("body")]),
    )
    # The text travels once, in the row if that has it.
    body = F.col("body") if "body" in state.columns else F.col("row.text")
    data = ascii_lower(F.coalesce(body, F.lit(""))).cast("binary")
    finished, depth, width = [], 0, first_digit
    while True:
        dealt = state.withColumns(
            {
                "digit": F.substring(data, depth + 1, width),
                "ended": F.length(data) <= depth + width,
            }
        )
        groups = settle(
            dealt.groupBy("group", "digit", "ended")
            .agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
            .withColumn("open", ~F.col("ended") & (F.col("group_size") > 1))
            .withColumn("next", F.monotonically_increasing_id()),
            "radix-groups",
        )
        stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) if only_kept else F.lit(bool(carry))
        needed = {"row": F.col("open") | stays, "body": F.col("open")}
        joined = settle(
            dealt.join(groups, ["group", "digit", "ended"]).select(
                F.col("next").alias("group"),
                *(F.when(needed[c], F.col(c)).alias(c) if c in needed else c for c in state.columns if c != "group"),
                "keep_id",
                "group_size",
                "open",
            ),
            "radix-rows",
        )
        finished.append(joined.where(~F.col("open")))
        if groups.where("open").isEmpty():
            break
        state = joined.where("open").select(*state.columns)
        depth, width = depth + width, width * GROWTH
    return reduce(DataFrame.unionAll, finished).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        "row",
    )


def without_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents without their copies, one row for each id and text, columns as they were."""
    kept = copies(docs, carry=docs.columns, only_kept=True, **options).where("kept")
    # Only rows that have equals can be there twice.
    repeated = kept.where("group_size > 1").dropDuplicates(["doc_id", "text_sha256"])
    return kept.where("group_size = 1").unionAll(repeated).select("row.*")
