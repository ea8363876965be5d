"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols (insult, threat, target, negation, report, clause end, other), and a
text becomes a string of them. Three transducers are composed over each clause: the first
marks an insult or threat as negated within ``NEGATION_REACH`` words after a negation, the
second marks it as reported after a word of reported speech, the third as aimed if the
clause names a target. A clause thus ends in one of the ``KINDS``; a document's score is
the logistic of the weights of the kinds that its clauses reach, each kind weighted
once for the first clause and once more for a second.

The weights start from ``PRIOR`` and are fitted to labelled rows, and so are insult words
beyond the fixed ones: a word joins when it occurs in at least ``MIN_CONTEXTS`` different
surroundings, counting the first place in each document, that are toxic far more often than
chance. Copies of one document share their surroundings and count once. Both fits read at
most ``SAMPLE`` labelled documents, chosen by the hash of their id.

Cases: null, empty and wordless texts get the score of a document without any match; rows
without label, or with null label, teach nothing; without labels the prior weights hold;
of several labels of one document the largest counts; repeated rows get equal scores; an
empty table gives an empty result; texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.common import WORD, settle, token_hashes

SAMPLE = 8192
MIN_CONTEXTS = 8
MIN_RATE = 0.5
MIN_DEVIATIONS = 8.0
MAX_LEARNED = 2000
NEGATION_REACH = 3
RIDGE = 0.05
TOKENS = WORD + r"|[.!?;:\n]"

INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(1, 7)
LEXICON = {
    INSULT: "idiot idiots moron morons loser losers scum trash garbage stupid worthless clown clowns pathetic"
    " disgusting dumb dumbass fool imbecile jerk creep vermin filth pig bastard asshole bitch",
    THREAT: "kill hurt destroy beat burn crush hang shoot stab strangle",
    TARGET: "you your you're u he she they him her them his their we us people these those",
    NEGATION: "not no never isn't aren't wasn't weren't don't doesn't didn't won't cannot can't without hardly",
    REPORT: "said says say called calls calling wrote writes quoted quote claimed told accused reported",
    END: ". ! ? ; : \n",
}
KINDS = ("aimed threat", "threat", "aimed insult", "insult", "reported", "negated")
PRIOR = (-2.5, 4.0, 2.0, 5.0, 3.5, 0.8, 0.2, *(1.0, 0.5, 1.0, 1.0, 0.2, 0.0))


def clause_kind(symbols: Sequence[tuple[int, int]]) -> int | None:
    """The strongest kind that a clause reaches; symbols are (position, symbol)."""
    negated_upto, reported, aimed = -1, False, any(s == TARGET for _, s in symbols)
    best: int | None = None
    for at, symbol in symbols:
        if symbol == NEGATION:
            negated_upto = at + NEGATION_REACH
        elif symbol == REPORT:
            reported = True
        elif symbol in (INSULT, THREAT):
            if at <= negated_upto:
                kind = 5
            elif reported:
                kind = 4
            else:
                kind = (0 if symbol == THREAT else 2) + (not aimed)
            best = kind if best is None else min(best, kind)
    return best


def features(symbols: Sequence[int], positions: Sequence[int]) -> tuple[int, ...]:
    """How many clauses reach each kind, up to 2, from the symbols of a text that are not other."""
    counts, clause = [0] * len(KINDS), []
    for at, symbol in [*zip(positions, symbols, strict=True), (0, END)]:
        if symbol != END:
            clause.append((at, symbol))
        elif clause:
            kind = clause_kind(clause)
            if kind is not None:
                counts[kind] = min(2, counts[kind] + 1)
            clause = []
    return tuple(counts)


def score(counts: Sequence[int], weights: Sequence[float]) -> float:
    k = len(KINDS)
    z = weights[0] + sum(weights[1 + i] * (c > 0) + weights[1 + k + i] * (c > 1) for i, c in enumerate(counts))
    return 1 / (1 + math.exp(-z))


@dataclass
class Grammar:
    """Sorted token hashes with their symbols, and the weights."""

    hashes: np.ndarray
    symbols: np.ndarray
    weights: tuple[float, ...] = PRIOR

    def features(self, tokens: pa.ListArray) -> list[tuple[int, ...]]:
        values = tokens.values.to_numpy(zero_copy_only=False)
        offsets = tokens.offsets.to_numpy()
        place = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        symbol = np.where(self.hashes[place] == values, self.symbols[place], 0)
        strong = np.concatenate([[0], np.cumsum((symbol == INSULT) | (symbol == THREAT))])
        none, out = (0,) * len(KINDS), []
        for start, stop in zip(offsets[:-1], offsets[1:], strict=True):
            if strong[stop] == strong[start]:
                out.append(none)
                continue
            some = np.flatnonzero(symbol[start:stop])
            out.append(features(symbol[start:stop][some].tolist(), some.tolist()))
        return out


def fixed_grammar(spark: SparkSession) -> Grammar:
    words = [(w, s) for s, line in LEXICON.items() for w in (line.split(" ") if s == END else line.split())]
    rows = spark.createDataFrame(words, "word string, symbol int").select(F.xxhash64("word").alias("h"), "symbol")
    found = {r.h: r.symbol for r in rows.collect()}
    return _grammar(found)


def _grammar(found: dict[int, int], weights: Sequence[float] = PRIOR) -> Grammar:
    hashes = np.array(sorted(found), np.int64)
    return Grammar(hashes, np.array([found[h] for h in hashes.tolist()], np.int8), tuple(weights))


def _first_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each different word of a document with a hash of its neighbours at its first place."""
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        for label, words in zip(toxic, batch.column("tokens"), strict=True):
            w = words.values.to_numpy(zero_copy_only=False)
            w = np.concatenate([[0], w, [0]]).astype(np.int64)
            different, at = np.unique(w[1:-1], return_index=True)
            context = w[at] * np.int64(0x9E3779B97F4A7C1) + w[at + 2]
            columns = [pa.array(different), pa.array(context), pa.array(np.full(len(at), label, np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "context", "toxic"])


def learned_words(sample: DataFrame) -> list[int]:
    """Hashes of words that go with toxic labels, the surest first, at most MAX_LEARNED."""
    base = sample.agg(F.avg("toxic")).first()[0]
    if not base or base >= 1:
        return []
    seen = sample.mapInArrow(_first_contexts, "word long, context long, toxic int")
    once = seen.groupBy("word", "context").agg(F.min("toxic").alias("toxic"))
    words = once.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("hits"))
    spread = F.sqrt(F.col("n") * base * (1 - base))
    surest = (
        words.where((F.col("n") >= MIN_CONTEXTS) & (F.col("hits") >= MIN_RATE * F.col("n")))
        .withColumn("deviations", (F.col("hits") - F.col("n") * base) / spread)
        .where(F.col("deviations") >= MIN_DEVIATIONS)
        .orderBy(F.desc("deviations"), "word")
        .limit(MAX_LEARNED)
    )
    return [r.word for r in surest.collect()]


def fit_weights(cells: Sequence[tuple[tuple[int, ...], int, int]]) -> tuple[float, ...]:
    """Ridge logistic weights, drawn to PRIOR, from (features, rows, toxic rows)."""
    if not cells:
        return PRIOR
    x = np.array([[1, *(c > 0 for c in f), *(c > 1 for c in f)] for f, _, _ in cells], float)
    n, hits = np.array([c[1] for c in cells], float), np.array([c[2] for c in cells], float)
    prior = np.array(PRIOR)
    w, pull = prior.copy(), np.array([1e-6, *[RIDGE] * (len(PRIOR) - 1)]) * max(1.0, math.sqrt(n.sum()))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (hits - n * p) - pull * (w - prior)
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Grammar:
    """The grammar fitted to at most ``sample`` labelled documents."""
    spark = docs.sparkSession
    fixed = fixed_grammar(spark)
    chosen = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    text = docs.select("doc_id", "text").where("text IS NOT NULL")
    # The chosen ids are at most SAMPLE rows of 12 bytes.
    rows = text.join(F.broadcast(chosen), "doc_id").select("toxic", token_hashes(F.col("text"), TOKENS).alias("tokens"))
    rows = settle(rows, "toxic-sample")
    found = dict.fromkeys(learned_words(rows), INSULT) | dict(
        zip(fixed.hashes.tolist(), fixed.symbols.tolist(), strict=True)
    )
    grammar = _grammar(found)
    cells: dict[tuple[int, ...], list[int]] = {}
    counted = apply(rows, grammar, ["toxic"]).groupBy("counts", "toxic").count()
    for row in counted.collect():  # at most 3 ** 6 x 2 rows
        cell = cells.setdefault(tuple(row.counts), [0, 0])
        cell[0] += row["count"]
        cell[1] += row["count"] * (row.toxic > 0)
    return _grammar(found, fit_weights([(k, *v) for k, v in sorted(cells.items())]))


def apply(rows: DataFrame, grammar: Grammar, keep: Sequence[str]) -> DataFrame:
    """The kept columns of rows with ``tokens``, the clause counts and the score."""
    shared = rows.sparkSession.sparkContext.broadcast((grammar.hashes, grammar.symbols, grammar.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Grammar(*shared.value)
        for batch in batches:
            counts = known.features(batch.column("tokens"))
            values = {c: score(c, known.weights) for c in set(counts)}
            columns = [
                *(batch.column(k) for k in keep),
                pa.array(counts, pa.list_(pa.int32())),
                pa.array([values[c] for c in counts], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "counts", "score"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.mapInArrow(run, f"{kinds}, counts array<int>, score double")


def judge(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, counts (clauses by kind, up to 2), score of every document."""
    rows = docs.select("doc_id", token_hashes(F.col("text"), TOKENS).alias("tokens"))
    return apply(rows, grammar, ["doc_id"])
