"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The token stream of a source is cut into blocks of ``block_words``. All blocks of the mix
are seats that go to the sources by highest quotients ``target / (2 * seats + 1)``. Each
source is laid out in shards of about ``shard_docs`` documents, of ``SHARD_BLOCKS`` blocks at
least; a source with one shard of fewer gets the seats that bring its target in blocks of its
own size, so it misses the target by half a block at most. The seats of a source go to its shards
by the same rule on the shards' sizes, which gives every shard an integer quota. Inside a
shard the documents lie end to end in seeded order, and blocks are chosen evenly from a
seeded start: of ``n`` blocks with a quota of ``q``, each is taken ``q // n`` times or once
more. Everything per document is closed-form integer arithmetic on its offset.

Documents are dealt out and ordered by a hash of id and size. Rows of a source that share both
(repeated rows, rows without id) are numbered, and the number goes into the hash: they lie in
all shards, end to end, and the result is the same for any layout of the table.

Only one row per source reaches the driver. Cases: a null text has no words; documents
without words, and sources made of them alone, are taken 0 times; a null source is a source
of its own, the last in order; an empty table gives an empty result; repeated rows are
documents of their own; a text longer than a shard is a shard's larger part and is taken like
others. Columns other than id, text and source are never looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerproof.llm.common import packed, settle

BLOCK_WORDS = 64
SHARD_DOCS = 4096
# A shard has many blocks, so that rounding their number changes their size little.
SHARD_BLOCKS = 32
MAX_REPEATS = 3
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def cycling_weights(sources: Sequence[str | None]) -> list[int]:
    """1, 2, 3, repeating."""
    return [i % 3 + 1 for i in range(len(sources))]


def share_out(
    sizes: Sequence[int], weights: Sequence[float], budget: int, most: int = MAX_REPEATS
) -> list[Fraction]:
    """Targets by weight; none above ``most`` times its size, the excess shared again."""
    targets = [Fraction(0)] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s], Fraction(budget)
    while open_:
        total = sum(Fraction(weights[i]) for i in open_)
        share = {i: left * Fraction(weights[i]) / total for i in open_}
        over = [i for i in open_ if share[i] > most * sizes[i]]
        for i in over or open_:
            targets[i] = Fraction(most * sizes[i]) if over else share[i]
        left -= sum(targets[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)] if over else []
    return targets


def sainte_lague(weights: Sequence[Fraction], seats: int) -> list[int]:
    """Seats by highest quotients; equal quotients go to the earlier one.

    The bulk follows from the quotients' bounds, so the work grows with the number of
    parties and not with the number of seats.
    """
    total, n = sum(weights), len(weights)
    if not total:
        return [0] * n
    won = [max(0, int(w * (seats - Fraction(n, 2)) / total - Fraction(1, 2))) for w in weights]
    heap = [(-w / (2 * s + 1), i) for i, (w, s) in enumerate(zip(weights, won, strict=True)) if w]
    heapq.heapify(heap)
    for _ in range(seats - sum(won)):
        _, i = heap[0]
        won[i] += 1
        heapq.heapreplace(heap, (-weights[i] / (2 * won[i] + 1), i))
    return won


def _shard_quotas(shards: DataFrame) -> DataFrame:
    """Adds blocks and quota to shards (number, shard, shard_size, seats of the source)."""
    source = Window.partitionBy("number")
    exact = F.col("shard_size") / F.col("all_size")
    bounds = (
        shards.where("shard_size > 0")
        .withColumn("n", F.count("*").over(source))
        .withColumn("all_size", F.sum("shard_size").over(source))
        .withColumn("blocks", F.greatest(F.lit(1), F.round(F.col("shard_size") / BLOCK_WORDS)))
        .withColumn("blocks", F.col("blocks").cast("long"))
        .withColumn("low", F.floor(exact * (F.col("seats") - F.col("n") / 2) - 0.5))
        .withColumn("low", F.greatest(F.lit(0), F.col("low")))
        .withColumn("high", F.ceil(exact * (F.col("seats") + F.col("n") / 2) + 0.5))
        .withColumn("sure", F.least("low", F.col("blocks") * MAX_REPEATS))
        .withColumn("high", F.least("high", F.col("blocks") * MAX_REPEATS))
        .withColumn("sure_all", F.sum("sure").over(source))
    )
    rank = F.row_number().over(source.orderBy(F.desc("quotient"), "shard", "seat"))
    won = (
        bounds.where("high > sure")
        .withColumn("seat", F.explode(F.sequence("sure", F.col("high") - 1)))
        .withColumn("quotient", F.col("shard_size") / (2 * F.col("seat") + 1))
        .withColumn("rank", rank)
        .where(F.col("rank") <= F.col("seats") - F.col("sure_all"))
        .groupBy("number", "shard")
        .agg(F.count("*").alias("more"))
    )
    return bounds.join(won, ["number", "shard"], "left").select(
        "number",
        "shard",
        "shard_size",
        "blocks",
        (F.col("sure") + F.coalesce("more", F.lit(0))).alias("quota"),
    )


def _chosen(j: str) -> str:
    """SQL: how many blocks before block ``j`` of a shard are taken, repeats counted."""
    end = f"({j} + turn)"
    return (
        f"((least({end}, blocks) * quota) div blocks - (turn * quota) div blocks"
        f" + if({end} > blocks, (({end} - blocks) * quota) div blocks, 0))"
    )


def _taken_before(x: str) -> str:
    """SQL: words taken from the first ``x`` words of a shard, repeats counted."""
    j = f"(({x} * blocks) div shard_size)"
    part = f"({x} * blocks - {j} * shard_size) * ({_chosen(f'{j} + 1')} - {_chosen(j)})"
    return f"(({_chosen(j)} * shard_size + {part} + blocks div 2) div blocks)"


def _tie_numbers(sized: DataFrame) -> DataFrame:
    """nr, tie (from 1) of all rows but the first of those that share source, id and size.

    Rows are numbered within the task that wrote them, behind those of earlier tasks, so no
    group of equal rows is brought together.
    """
    rows = sized.where("size > 0").select(
        "nr", F.shiftright("nr", 33).alias("task"), F.xxhash64("source", "doc_id", "size").alias("alike")
    )
    counts = rows.groupBy("alike", "task").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("alike")
    earlier = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("all", F.sum("n").over(whole))
        .where(F.col("all") > 1)
        .select("alike", "task", "before")
    )
    within = F.row_number().over(Window.partitionBy("alike", "task").orderBy("nr")) - 1
    numbered = rows.join(shared, ["alike", "task"]).select("nr", (F.col("before") + within).alias("tie"))
    return settle(numbered.where("tie > 0"), "mix-ties")


def mix(
    docs: DataFrame,
    weights: Callable[[Sequence[str | None]], Sequence[float]] = cycling_weights,
    *,
    budget: int | None = None,
    seed: int = 7,
    shard_docs: int = SHARD_DOCS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document with what the mix takes of it.

    ``weights`` gets the sources by code point, null last. ``budget`` is the size of the
    mix in words, by default that of all documents; it is bounded by ``MAX_REPEATS`` times
    each source. Columns: doc_id, source, size, source_size, target, shard, quota, start
    (word offset in the shard), taken (words, repeats counted), copies (how often the block
    with the document's middle word is taken: the whole-document form of the mix), and
    ``row``, a struct of the carried columns.
    """
    spark = docs.sparkSession
    sized = settle(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), packed(docs, carry), F.monotonically_increasing_id().alias("nr")
        ),
        "mix-sizes",
    )
    sized = sized.join(_tie_numbers(sized), "nr", "left").withColumn("tie", F.coalesce("tie", F.lit(0)).cast("long"))
    stats = sized.groupBy("source").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    stats = sorted(stats.collect(), key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.s for r in stats]
    budget = sum(sizes) if budget is None else budget
    names = [r.source for r in stats]
    targets = share_out(sizes, weights(names), budget)
    seats = sainte_lague(targets, round(sum(targets) / BLOCK_WORDS))
    for i, size in enumerate(sizes):
        if 0 < size < SHARD_BLOCKS * BLOCK_WORDS:
            blocks = max(1, int(Fraction(size, BLOCK_WORDS) + Fraction(1, 2)))
            seats[i] = int(targets[i] * blocks / size + Fraction(1, 2))
    least = SHARD_BLOCKS * BLOCK_WORDS
    plan = spark.createDataFrame(
        [
            (i, r.source, r.s, float(targets[i]), seats[i], n := max(1, -(-r.n // shard_docs)), max(1, min(n, r.s // least)))
            for i, r in enumerate(stats)
        ],
        "number int, plan_source string, source_size long, target double, seats long, parts long, worded long",
    )


    def hashed(by: int) -> Column:
        alone = F.xxhash64(F.lit(by), "doc_id", "size")
        return F.when(F.col("tie") == 0, alone).otherwise(F.xxhash64(F.lit(by), "doc_id", "size", "tie"))

    placed = (
        sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("place", hashed(seed))
        # Documents without words bring nothing to a shard; they are dealt out by rows.
        .withColumn("shard", F.pmod("place", F.when(F.col("size") > 0, F.col("worded")).otherwise(F.col("parts"))))
        .withColumn("place", hashed(seed + 1))
    )
    shards = placed.groupBy("number", "shard", "seats").agg(F.sum("size").alias("shard_size"))
    quotas = settle(_shard_quotas(shards), "mix-quotas")
    order = Window.partitionBy("number", "shard").orderBy("place", "doc_id", "size", "tie")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = (
        placed.withColumn("stop", F.sum("size").over(order))
        .withColumn("start", F.col("stop") - F.col("size"))
        .join(quotas, ["number", "shard"], "left")
        .withColumn("turn", F.pmod(F.xxhash64(F.lit(seed), "number", "shard"), "blocks"))
        .withColumn("middle", F.expr("(start + stop) div 2 * blocks div shard_size"))
    )
    taken = F.expr(f"{_taken_before('stop')} - {_taken_before('start')}")
    copies = F.expr(f"{_chosen('(middle + 1)')} - {_chosen('middle')}")
    none = F.lit(0).cast("long")
    return laid.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "shard",
        F.coalesce("quota", none).alias("quota"),
        "start",
        F.when(F.col("size") > 0, taken).otherwise(none).alias("taken"),
        F.when(F.col("size") > 0, copies).otherwise(none).cast("int").alias("copies"),
        "row",
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as whole documents: each row as often as its middle block is taken."""
    mixed = mix(docs, carry=docs.columns, **options).where("copies > 0")
    repeated = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return repeated.select("row.*")
