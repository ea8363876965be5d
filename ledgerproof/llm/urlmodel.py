"""URL filter: suffix rules, and a character language-model ratio for what no rule covers.

Two variable-order Markov models of bytes are trained, on URLs that the rules accept and
on those that they reject. The probability of a byte after a context of ``k`` bytes is
smoothed with that after ``k - 1`` bytes, down to a uniform one:
``p_k = (n(context, byte) + A * p_{k-1}) / (n(context) + A)``. A URL's score is the mean
over its bytes of the difference of the log probabilities, so long URLs are not favoured.
The cut is where the two kinds of held-out ruled URLs are best told apart (largest mean of
the two hit rates).

Counts are exact and live in a table with a row for every n-gram of the training URLs, which
grows with them; none of it is gathered. An n-gram of order ``k``, ``k`` bytes of context and
the byte after it, is a number with ``k`` in the bits above. What a byte adds to a score depends on the
``ORDER`` bytes before it only, so URLs are put into blocks, the distinct n-grams of the
blocks are joined to the counts, and each block gets the ones it holds back as a lookup.

Cases: a null URL or one without ``://`` has an empty host and path, no rule and, without
bytes to judge, a score of 0; if one of the two classes is empty every score is 0; a score
at the cut is accepted; an empty table gives an empty result; repeated rows are all judged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerproof.llm.common import ascii_lower, settle, slices

ORDER = 4
WIDTH = 8 * (ORDER + 1)
BLOCK = 1 << 16
PRIOR = 2.0
BINS = 400
BIN_WIDTH = 0.02
# (rule, verdict)
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, tail = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _windows(urls: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of all URLs the ``ORDER`` bytes before it and itself as a number, and its URL."""
    raw = [b"\0" * ORDER + (u or "").lower().encode("utf-8", "surrogatepass") for u in urls]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    first = np.cumsum([0, *map(len, raw)])[:-1]
    judged = np.ones(len(data), bool)
    for k in range(ORDER):
        judged[first + k] = False
    at = np.flatnonzero(judged)
    window = np.zeros(len(at), np.int64)
    for k in range(ORDER, -1, -1):
        window = window << 8 | data[at - k]
    return window, owner[at]


def _gram(window: np.ndarray, k: int) -> np.ndarray:
    """The n-grams of order ``k`` that end windows."""
    return window & (1 << 8 * (k + 1)) - 1 | k << WIDTH


@dataclass
class Models:
    """Counts of n-grams in the rejected and the accepted URLs: rows (gram, n0, n1)."""

    grams: DataFrame

    def window_scores(self, windows: DataFrame) -> DataFrame:
        """(window, gain): the difference of the log probabilities, of distinct rows (window)."""
        low = (1 << WIDTH) - 1
        every = F.array(
            *(F.col("window").bitwiseAND((1 << 8 * (k + 1)) - 1).bitwiseOR(k << WIDTH) for k in range(ORDER + 1))
        )
        needed = windows.select(F.explode(every).alias("gram")).distinct()
        order = F.shiftright("gram", WIDTH)
        context = F.shiftleft(order, WIDTH).bitwiseOR(F.shiftright(F.col("gram").bitwiseAND(low), 8))
        totals = self.grams.groupBy(context.alias("context")).agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1"))
        # No key has more than 256 rows: a context is followed by 256 bytes at most.
        counted = needed.withColumn("context", context).join(self.grams, "gram", "left").join(totals, "context", "left")
        counted = settle(counted.fillna(0, ["n0", "n1", "c0", "c1"]).withColumn("order", order), "url-ngrams")
        p = None
        for k in range(ORDER + 1):
            of = counted.where(F.col("order") == k).withColumn("own", F.col("gram").bitwiseAND(low))
            if p is None:
                of = of.withColumns({"q0": F.lit(1 / 256), "q1": F.lit(1 / 256)})
            else:
                of = of.withColumn("shorter", F.col("own").bitwiseAND((1 << 8 * k) - 1)).join(p, "shorter")
            smoothed = ((F.col(f"n{c}") + PRIOR * F.col(f"q{c}")) / (F.col(f"c{c}") + PRIOR) for c in (0, 1))
            p = of.select(F.col("own").alias("shorter"), *(x.alias(f"q{c}") for c, x in enumerate(smoothed)))
        return p.select(F.col("shorter").alias("window"), (F.log("q1") - F.log("q0")).alias("gain"))

    def scores(self, urls: Sequence[str | None]) -> np.ndarray:
        rows = self.grams.sparkSession.createDataFrame(list(enumerate(urls)), "place long, url string")
        return np.array([r.lm_score for r in add_score(rows, self).orderBy("place").collect()])


def summed(counted: DataFrame) -> Models:
    """The models of partial counts (gram, n0, n1)."""
    total = counted.groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    return Models(settle(total, "url-counts"))


def train(ruled: DataFrame) -> Models | None:
    """Models from rows (url, verdict); None if a class has no URL."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, allowed = batch.column("url").to_pylist(), batch.column("verdict").to_pylist()
            allowed = np.array([v == "allow" for v in allowed], bool)
            for part in slices([len(u or "") for u in urls]):
                window, owner = _windows(urls[part])
                own = allowed[part][owner]
                for k in range(ORDER + 1):
                    grams, which = np.unique(_gram(window, k), return_inverse=True)
                    n = [np.bincount(which[own == bool(c)], minlength=len(grams)).astype(np.int64) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (grams, *n)], ["gram", "n0", "n1"])

    models = summed(ruled.select("url", "verdict").mapInArrow(count, "gram long, n0 long, n1 long"))
    met = models.grams.agg(F.max("n0").alias("n0"), F.max("n1").alias("n1")).first()
    return models if met.n0 and met.n1 else None


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = [len(u or "") for u in batch.column("url").to_pylist()]
        for part in slices(lengths, BLOCK):
            rows = batch.slice(part.start, part.stop - part.start).to_struct_array()
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], ["rows"])


def _block_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, urls in zip(batch.column("block").to_pylist(), batch.column("urls").to_pylist(), strict=True):
            found = np.unique(_windows(urls)[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), pa.array(found)], ["block", "window"])


def _block_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = []
        for urls, found in zip(batch.column("urls").to_pylist(), batch.column("found"), strict=True):
            window, owner = _windows(urls)
            total = np.zeros(len(urls))
            if len(window):
                known, gain = (found.values.field(n).to_numpy() for n in ("window", "gain"))
                order = np.argsort(known)
                gains = gain[order][np.searchsorted(known, window, sorter=order)]
                total = np.bincount(owner, gains, len(urls))
            scores.append(total / np.maximum(np.bincount(owner, minlength=len(urls)), 1))
        columns = [batch.column("rows"), pa.array(scores, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["rows", "scores"])


def add_score(pages: DataFrame, models: Models | None) -> DataFrame:
    """Adds lm_score to rows with a column url."""
    if models is None:
        return pages.withColumn("lm_score", F.lit(0.0))
    rows = T.ArrayType(pages.schema)
    blocks = pages.mapInArrow(_blocks, T.StructType([T.StructField("rows", rows)]))
    blocks = settle(blocks.withColumn("block", F.monotonically_increasing_id()), "url-blocks")
    urls = blocks.select("block", F.col("rows.url").alias("urls"))
    held = settle(urls.mapInArrow(_block_windows, "block long, window long"), "url-windows")
    gains = models.window_scores(held.select("window").distinct())
    found = held.join(gains, "window").groupBy("block").agg(F.collect_list(F.struct("window", "gain")).alias("found"))
    kept = T.StructType([T.StructField("rows", rows), T.StructField("scores", T.ArrayType(T.DoubleType()))])
    # A block of empty URLs has found nothing.
    whole = blocks.join(found, "block", "left").select("rows", F.col("rows.url").alias("urls"), "found")
    judged = whole.mapInArrow(_block_scores, kept).select(F.explode(F.arrays_zip("rows", "scores")).alias("row"))
    return judged.select("row.rows.*", F.col("row.scores").alias("lm_score"))


def best_cut(scored: DataFrame) -> float:
    """The cut between rows (verdict, lm_score) of both verdicts; ties go to the one nearest 0."""
    bin_ = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("lm_score") / BIN_WIDTH)))
    table = np.zeros((2, 2 * BINS + 1))
    for row in scored.groupBy(bin_.alias("bin"), "verdict").count().collect():
        table[int(row.verdict == "allow"), int(row.bin) + BINS] += row["count"]
    if not table.sum(1).all():
        return 0.0
    below = np.cumsum(table, 1) - table
    share = below / table.sum(1, keepdims=True)
    gain = share[0] - share[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(min((best - BINS) * BIN_WIDTH, key=abs))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, lm_score, lm_cut of every page."""
    urls = pages.select("page_id", "url")
    host, path = parts(F.col("url"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    marked = urls.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "verdict": verdict})
    ruled = marked.where("verdict IS NOT NULL")
    held_out = F.crc32("url") % 10 == 0
    models = train(ruled.where(~held_out))
    scored = settle(add_score(marked, models), "url-scores") if models else add_score(marked, None)
    cut = best_cut(scored.where("verdict IS NOT NULL").where(held_out)) if models else 0.0
    by_model = F.when(F.col("lm_score") >= cut, "allow").otherwise("block")
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", by_model).alias("verdict"),
        "lm_score",
        F.lit(cut).alias("lm_cut"),
    )
