"""Near-duplicate groups by DartMinHash signatures and banded joining.

A document is the multiset of its runs of five words (fewer words make one run of all of
them); the weight of a run is how often it occurs. Over each element stands a region as
high as its weight, and a Poisson process of hashed darts falls on it: unit by unit of
weight, dart after dart, each with an arrival time and one of ``COORDINATES`` coordinates,
the same in every document that has this much of the element. Per coordinate the earliest
dart is kept. Two documents keep the same dart with the probability of their weighted
Jaccard similarity. Only about ``COORDINATES * (log(COORDINATES) + SPARE)`` darts are
thrown per document, however many words it has.

Signatures are cut into ``BANDS`` bands of ``ROWS`` coordinates: texts of similarity 0.8
share a bucket with probability ``1 - 8e-6``. Texts with the same words in the same order
are one representative from the start. No pairs are formed inside a bucket. First every
bucket is led by the member that meets most others over all its buckets, so that a group has
few leaders, and all others are compared with it. A comparison is screened: where one byte
per coordinate agrees in less than the threshold less ``MARGIN`` (four standard deviations),
it is over. The rest is compared exactly, on the full multisets; what reaches ``THRESHOLD``
is linked. As one minus the similarity is a metric, a linked document leaves its bucket
unless it could still be linked to an unlinked one there (its distance to the leader is at
least the least distance of those, less ``1 - THRESHOLD``). The distance of one that was
screened out is taken to be at least one minus its agreement and ``MARGIN``; agreements down
to ``NEAR``, below which it holds nothing, are carried for this.

Members of buckets with several classes left get keys of their own: ``LONG_KEYS`` draws of
``LONG_ROWS`` coordinates. A pair at 0.8 has one in common but for 9e-6, one at 0.6 in a
tenth of all cases, so unlike texts of a large group hardly meet any more. In each round
every key with several classes names leaders among all but its largest class, one at first and
``LEADERS`` times as many as before in each further round, and all members of other classes are compared
with these; what is linked by then, by any chain, is one class and is not compared. Neither are
two members that cannot reach ``THRESHOLD`` for certain: what stands in one member alone, of all
that wait, is shared with nobody, so the smaller number of shared runs bounds what two have in
common. One that is too far from everything this way gets no keys. Of two
classes the pair that looks most alike is compared first and the others only if it fails. So two documents
that share a bucket, a key and pass the screen end in one class, but for estimates more than
``MARGIN`` too low (3e-5 a pair), and a bucket that is one large class costs one comparison a
document.

Classes are the connected components of the links; the smallest id of a class stays. Cases:
null texts and texts without words are classes of their own; equal rows are copies; ids are unique but for
repeated rows; a null id joins a class by its text, and one row of a class without any id is kept, which is why
rows with null ids are written once and numbered; an empty table gives an empty result; texts are read whole;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerproof.llm.common import packed, settle, slices, token_hashes
from ledgerproof.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS = 64
ROWS = 8
COORDINATES = BANDS * ROWS
SPARE = 3.0
MARGIN = 0.07
# Less agreement, by MARGIN, is too far from a leader to be linked to what is linked to it.
NEAR = 2 * THRESHOLD - 1 - MARGIN
LONG_ROWS = 16
LONG_KEYS = 400
LEADERS = 16
# Words of the texts that are signed together: a few dozen darts a word are in memory at once.
SLICE = 1 << 15
DARTS = COORDINATES * (math.log(COORDINATES) + SPARE)

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _A
    return x ^ (x >> np.uint64(31))


def shingles(tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of all documents of a batch, in order, and their offsets."""
    counts = np.diff(offsets)
    runs = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    start = np.repeat(offsets[:-1] - bounds[:-1], runs) + np.arange(bounds[-1])
    words = tokens.view(np.uint64)
    hashed = np.zeros(len(start), np.uint64)
    owner = np.repeat(np.arange(len(counts)), runs)
    stop = offsets[1:][owner]
    for j in range(WORDS):
        at = start + j
        word = np.where(at < stop, words[np.minimum(at, max(len(words) - 1, 0))], np.uint64(0))
        hashed = mixed(hashed * np.uint64(3) + word + np.uint64(j + 1))
    return hashed, bounds


def multiplicities(hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each run, how many equal ones stand before it in its document."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(np.uint64)
    key = (owner << np.uint64(40)) | (hashed >> np.uint64(24))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.ones(len(key), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.arange(len(key))
    earlier = np.empty(len(key), np.int64)
    earlier[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return earlier


def signatures(hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The earliest dart of every coordinate, documents x COORDINATES; zeros without runs."""
    n, runs = len(bounds) - 1, np.diff(bounds)
    unit = multiplicities(hashed, bounds).astype(np.uint64)
    element = mixed(hashed + mixed(unit + np.uint64(7)))
    owner = np.repeat(np.arange(n), runs)
    until = DARTS / np.maximum(runs, 1)
    first = np.full(n * COORDINATES, np.inf)
    kept = np.zeros(n * COORDINATES, np.uint64)
    todo = runs > 0
    while todo.any():
        own = np.flatnonzero(todo[owner])
        begun, dart, block = np.zeros(len(own)), 0, 1
        while len(own):
            number = np.arange(dart, dart + block, dtype=np.uint64)
            drawn = mixed(element[own, None] + mixed(number * _A + np.uint64(11)))
            gap = -np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            time = begun[:, None] + np.cumsum(gap, 1)
            row, col = np.nonzero(time <= until[owner[own], None])
            thrown, when = drawn[row, col], time[row, col]
            place = (mixed(thrown ^ _A) % np.uint64(COORDINATES)).astype(np.int64)
            place += owner[own][row] * COORDINATES
            np.minimum.at(first, place, when)
            won = first[place] == when
            kept[place[won]] = thrown[won]
            more = time[:, -1] <= until[owner[own]]
            own, begun = own[more], time[more, -1]
            # Each block is a part of what was thrown before, so that few darts lie beyond ``until``.
            dart += block
            block = min(max(8, dart // 2), 64)
        todo = np.isinf(first.reshape(n, COORDINATES)).any(1) & (runs > 0)
        until = np.where(todo, until * 2, until)
    return kept.reshape(n, COORDINATES)


def bands(kept: np.ndarray) -> np.ndarray:
    """One hash per band."""
    cut = kept.reshape(len(kept), BANDS, ROWS)
    out = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), cut.shape[:2]).copy()
    for i in range(ROWS):
        out = mixed(out * np.uint64(5) + cut[:, :, i])
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column("tokens")
        offsets = tokens.offsets.to_numpy().astype(np.int64)
        values = tokens.values.to_numpy(zero_copy_only=False)
        for part in slices(np.diff(offsets).tolist(), SLICE):
            edge = offsets[part.start : part.stop + 1]
            own = values[edge[0] : edge[-1]]
            edge = edge - edge[0]
            keys = [
                hashlib.blake2b(own[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)
            ]
            hashed, bounds = shingles(own, edge)
            kept = signatures(hashed, bounds)
            sketch = (kept >> np.uint64(20)).astype(np.uint8).view(np.int8)
            lists = pa.ListArray.from_arrays(
                np.arange(len(keys) + 1, dtype=np.int32) * BANDS, pa.array(bands(kept).ravel())
            )
            columns = [
                *(batch.column(c).slice(part.start, part.stop - part.start) for c in ("doc_id", "unnamed")),
                pa.array(keys, pa.binary()),
                lists,
                pa.ListArray.from_arrays(
                    np.arange(len(keys) + 1, dtype=np.int32) * COORDINATES, pa.array(sketch.ravel())
                ),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "unnamed", "words", "bands", "sketch"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets of hashes."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    common, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = np.minimum(n[i], m[j]).sum()
    return float(shared / (len(a) + len(b) - shared)) if len(a) + len(b) else 1.0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def runs(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        return shingles(column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy().astype(np.int64))

    for batch in batches:
        a, at = runs(batch.column("tokens"))
        b, bt = runs(batch.column("leader_tokens"))
        pairs = zip(at[:-1], at[1:], bt[:-1], bt[1:], strict=True)
        value = [similarity(a[i:j], b[k:m]) for i, j, k, m in pairs]
        columns = [batch.column("doc"), batch.column("leader"), pa.array(value, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "leader", "similarity"])


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Exact similarities of pairs (doc, leader); ``tokens`` holds (doc, tokens)."""
    leaders = tokens.select(F.col("doc").alias("leader"), F.col("tokens").alias("leader_tokens"))
    rows = pairs.join(tokens, "doc").join(leaders, "leader")
    return rows.mapInArrow(_compare, "doc long, leader long, similarity double")


def _screened(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The pairs (doc, leader) whose sketches agree in ``least`` or more, with their agreement, of 0 to 1."""
    of_leader = sketches.select(F.col("doc").alias("leader"), F.col("sketch").alias("leader_sketch"))
    same = F.size(F.filter(F.zip_with("sketch", "leader_sketch", lambda a, b: a == b), lambda e: e))
    rows = pairs.join(sketches, "doc").join(of_leader, "leader")
    return rows.select("doc", "leader", (same / COORDINATES).alias("agreement")).where(F.col("agreement") >= least)


def _thinned(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same components: each b has one to its smallest a, which has one to the others.

    Members of a group share their leaders, so most of the links among these are the same.
    A b has at most as many leaders as bands.
    """
    of_b = links.groupBy("b").agg(F.sort_array(F.collect_set("a")).alias("all"))
    first = F.get("all", F.lit(0))
    others = F.transform(F.concat(F.array("b"), F.slice("all", 2, F.size("all"))), lambda x: F.struct(first.alias("a"), x.alias("b")))
    return of_b.select(F.explode(others).alias("link")).select("link.*").distinct()


def _first_round(waiting: DataFrame, sketches: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of every bucket's members to its leader, and the members (bucket, doc) that may have more."""
    # Who meets most others leads all its buckets, so that a group has few leaders and few pairs.
    sizes = waiting.groupBy("bucket").agg((F.count("*") - 1).alias("others"))
    met = waiting.join(sizes, "bucket").groupBy("doc").agg(F.sum("others").alias("meets"))
    first = F.max(F.struct("meets", (-F.col("doc")).alias("back")))
    leaders = waiting.join(met, "doc").groupBy("bucket").agg(first.alias("first"))
    leaders = leaders.select("bucket", (-F.col("first.back")).alias("leader"))
    led = settle(waiting.join(leaders, "bucket").where("doc <> leader").select("bucket", "doc", "leader"), "led")
    pairs = settle(_screened(led.select("doc", "leader").distinct(), sketches, NEAR), "met")
    found = _verified(pairs.where(F.col("agreement") >= THRESHOLD - MARGIN).select("doc", "leader"), tokens)
    found = settle(found, "verified")
    linked = F.coalesce(F.col("similarity") >= THRESHOLD, F.lit(False))
    # Whose agreement was below NEAR is at least this far from the leader.
    farthest = F.lit(1 - NEAR - MARGIN)
    at_least = F.coalesce(1 - F.col("similarity"), 1 - MARGIN - F.col("agreement"), farthest)
    judged = led.join(pairs.join(found, ["doc", "leader"], "left"), ["doc", "leader"], "left")
    judged = settle(judged.select("bucket", "doc", "similarity", linked.alias("linked"), at_least.alias("at_least")), "judged")
    nearest = judged.where("NOT linked").groupBy("bucket").agg(F.min("at_least").alias("nearest"))
    reach = F.least("nearest", farthest) - (1 - THRESHOLD) - 1e-9
    stays = ~F.col("linked") | (1 - F.col("similarity") >= reach)
    left = judged.join(nearest, "bucket").where(stays).select("bucket", "doc")
    links = found.where(linked).select(F.col("leader").alias("a"), F.col("doc").alias("b"))
    return settle(_thinned(links), "thinned"), left


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of every run of every document, numbered among the equal ones, as rows (doc, run)."""
    for batch in batches:
        tokens, docs = batch.column("tokens"), batch.column("doc").to_numpy()
        offsets = tokens.offsets.to_numpy().astype(np.int64)
        values = tokens.values.to_numpy(zero_copy_only=False)
        for part in slices(np.diff(offsets).tolist()):
            edge = offsets[part.start : part.stop + 1]
            hashed, bounds = shingles(values[edge[0] : edge[-1]], edge - edge[0])
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            order = np.lexsort((hashed, owner))
            run, owner = hashed[order], owner[order]
            first = np.ones(len(run), bool)
            first[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
            at = np.arange(len(run))
            unit = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
            rows = [pa.array(docs[part][owner]), pa.array(mixed(run + mixed(unit + np.uint64(7))).view(np.int64))]
            yield pa.RecordBatch.from_arrays(rows, ["doc", "run"])


def _reachable(shared: Column, runs: Column, other_runs: Column) -> Column:
    """Whether documents of so many runs can be linked with at most ``shared`` in common."""
    return shared >= (THRESHOLD - 1e-9) * (runs + other_runs - shared)


def _hopeful(left: DataFrame, tokens: DataFrame) -> DataFrame:
    """(doc, runs, shared) of those of ``left`` that can be linked to another: how many runs, and how many not alone in it.

    Equal hashes of different runs only make ``shared`` larger.
    """
    runs = settle(left.join(tokens, "doc").select("doc", "tokens").mapInArrow(_runs, "doc long, run long"), "runs")
    alone = runs.groupBy("run").agg(F.count("*").alias("n"), F.min("doc").alias("doc")).where("n = 1")
    alone = alone.groupBy("doc").agg(F.count("*").alias("alone"))
    counted = runs.groupBy("doc").agg(F.count("*").alias("runs")).join(alone, "doc", "left")
    shared = F.col("runs") - F.coalesce("alone", F.lit(0))
    counted = counted.select("doc", "runs", shared.alias("shared"))
    # The best that could be met is what is shared, and no more.
    return settle(counted.where(_reachable(F.col("shared"), F.col("runs"), F.col("shared"))), "hopeful")


def long_keys(sketch: np.ndarray) -> np.ndarray:
    """A hash of ``LONG_ROWS`` drawn bytes of a sketch for each of ``LONG_KEYS`` draws, documents x LONG_KEYS."""
    draw = np.random.default_rng(LONG_KEYS)
    chosen = np.stack([draw.choice(COORDINATES, LONG_ROWS, replace=False) for _ in range(LONG_KEYS)])
    halves = np.ascontiguousarray(sketch[:, chosen]).view(np.uint64)
    out = np.broadcast_to(mixed(np.arange(1, LONG_KEYS + 1, dtype=np.uint64)), halves.shape[:2])
    for i in range(halves.shape[2]):
        out = mixed(out * np.uint64(5) + mixed(halves[:, :, i] + np.uint64(1)))
    return out.view(np.int64)


def _long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known = [batch.column(c).to_numpy() for c in ("doc", "runs", "shared")]
        sketch = batch.column("sketch").flatten().to_numpy().view(np.uint8).reshape(batch.num_rows, COORDINATES)
        for at in range(0, batch.num_rows, 256):
            keys = long_keys(sketch[at : at + 256])
            rows = [pa.array(np.repeat(c[at : at + 256], LONG_KEYS)) for c in known]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *rows], ["bucket", "doc", "runs", "shared"])


def _merged(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """(node, label) after classes have been joined; ``joined`` holds (node, label) of the classes that were.

    A class is named by its smallest node; one without a row in ``labels`` is a single node.
    """
    into = joined.select(F.col("node").alias("class"), F.col("label").alias("into"))
    moved = labels.join(into, F.col("label") == F.col("class"), "left").select("node", F.coalesce("into", "label").alias("label"))
    return moved.unionAll(joined.join(labels, "node", "left_anti").select("node", "label"))


def _of_classes(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets with several classes, with (class, open); of each bucket one class is not open."""
    own = members.join(labels, F.col("doc") == F.col("node"), "left")
    own = own.select(*members.columns, F.coalesce("label", "doc").alias("class"))
    # The largest class need not lead: of any two classes one is open.
    sizes = own.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("most"), F.count("*").alias("classes"))
    several = own.join(largest.where("classes > 1"), "bucket")
    return settle(several.select(*members.columns, "class", (F.col("class") != F.col("most.class")).alias("open")), "members")


def _links(waiting: DataFrame, sketches: DataFrame, tokens: DataFrame) -> DataFrame:
    """Links (a, b) that join all representatives of a class; ``waiting`` holds (bucket, doc)."""
    links, left = _first_round(waiting, sketches, tokens)
    labels = components(links)
    left = _of_classes(left, labels).select("doc").distinct()
    keys = _hopeful(left, tokens).join(sketches, "doc").select("doc", "runs", "shared", "sketch")
    keys = settle(keys.mapInArrow(_long, "bucket long, doc long, runs long, shared long"), "long-keys")
    several = keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members, leading = _of_classes(keys.join(several, "bucket"), labels), 1
    linked = F.col("similarity") >= THRESHOLD
    while not members.isEmpty():
        # The ranks are cut in the map tasks first, so that a large bucket is no task's load.
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("doc"))
        leaders = members.where("open").withColumn("rank", rank).where(F.col("rank") <= leading)
        own = (F.col(c).alias(f"leader_{c}") for c in ("runs", "shared"))
        leaders = settle(leaders.select("bucket", F.col("doc").alias("leader"), F.col("class").alias("of"), *own), "leaders")
        common = F.least("shared", "leader_shared")
        pairs = members.join(leaders, "bucket").where(F.col("class") != F.col("of"))
        pairs = pairs.where(_reachable(common, F.col("runs"), F.col("leader_runs")))
        pairs = pairs.select(
            F.least("doc", "leader").alias("doc"),
            F.greatest("doc", "leader").alias("leader"),
            F.struct(F.least("class", "of").alias("one"), F.greatest("class", "of").alias("other")).alias("classes"),
        )
        pairs = settle(pairs.distinct(), "led")
        met = _screened(pairs.select("doc", "leader"), sketches, THRESHOLD - MARGIN).join(pairs, ["doc", "leader"])
        met = settle(met, "met")
        # One link joins two classes, so the pair that looks most alike goes first.
        likely = met.groupBy("classes").agg(F.max(F.struct("agreement", "doc", "leader")).alias("p"))
        found = settle(_verified(likely.select("p.doc", "p.leader"), tokens).where(linked), "verified")
        joined = pairs.join(found, ["doc", "leader"], "left_semi").select("classes").distinct()
        rest = met.join(joined, "classes", "left_anti").join(likely.select("p.doc", "p.leader"), ["doc", "leader"], "left_anti")
        more = settle(_verified(rest.select("doc", "leader"), tokens).where(linked), "verified")
        for these in (found, more):
            links = links.unionAll(these.select(F.col("leader").alias("a"), F.col("doc").alias("b")))
        # Only the classes that were joined are looked at again, not all links of all rounds.
        new = pairs.join(found.unionAll(more), ["doc", "leader"], "left_semi")
        new = settle(new.select(F.col("classes.one").alias("a"), F.col("classes.other").alias("b")).distinct(), "joined")
        if not new.isEmpty():
            labels = settle(_merged(labels, components(new)), "merged")
        # Leaders have met everyone in their bucket and are done.
        done = leaders.select("bucket", F.col("leader").alias("doc"))
        members = _of_classes(members.drop("class", "open").join(done, ["bucket", "doc"], "left_anti"), labels)
        leading *= LEADERS
    return links


def _unnamed(docs: DataFrame) -> DataFrame:
    """The rows without id as (unnamed, text, row), written so that their numbers hold."""
    rows = docs.where(F.col("doc_id").cast("long").isNull())
    return settle(rows.select(F.monotonically_increasing_id().alias("unnamed"), "text", packed(docs, docs.columns)), "no-ids")


def _classes(docs: DataFrame, unnamed: DataFrame) -> DataFrame:
    """doc_id, unnamed (number of a row without id), class_id, class_size, copies, kept of every document."""
    id_ = F.col("doc_id").cast("long").alias("doc_id")
    named = docs.where(F.col("doc_id").cast("long").isNotNull()).select(id_, F.lit(None).cast("long").alias("unnamed"), "text")
    every = named.unionAll(unnamed.select(F.lit(None).cast("long"), "unnamed", "text"))
    rows = every.select("doc_id", "unnamed", token_hashes(F.col("text")).alias("tokens"))
    schema = "doc_id long, unnamed long, words binary, bands array<long>, sketch array<tinyint>"
    signed = rows.mapInArrow(_sign, schema).withColumn("doc", F.monotonically_increasing_id())
    signed = settle(signed, "signatures")
    # The smallest id, null last; of rows without id any one.
    first_of = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc", "unnamed"))
    alike = signed.where("words IS NOT NULL").groupBy("words").agg(first_of.alias("first"), F.count("*").alias("copies"))
    alike = settle(alike.select("words", "copies", "first", "first.doc"), "same-words")

    first = signed.join(alike.select("doc"), "doc", "left_semi")
    buckets = first.select("doc", F.explode("bands").alias("bucket")).distinct()
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    waiting = settle(buckets.join(shared, "bucket").select("bucket", "doc"), "buckets")
    candidates = first.select("doc", "doc_id", "unnamed", "sketch").join(waiting.select("doc").distinct(), "doc", "left_semi")
    candidates = settle(candidates, "sketches")
    texts = docs.select(id_, "text").join(candidates.select("doc", "doc_id"), "doc_id").dropDuplicates(["doc"])
    texts = texts.select("doc", "text").unionAll(unnamed.join(candidates, "unnamed").select("doc", "text"))
    tokens = texts.select("doc", token_hashes(F.col("text")).alias("tokens"))
    labels = components(_links(waiting, candidates.select("doc", "sketch"), settle(tokens, "candidates")))

    classes = alike.join(labels, F.col("doc") == F.col("node"), "left")
    classes = classes.select("words", "copies", "first", F.coalesce("label", "doc").alias("class"))
    sizes = classes.groupBy("class").agg(F.sum("copies").alias("class_size"), F.min("first").alias("stays"))
    joined = signed.join(classes.join(sizes, "class"), "words", "left")
    one = F.lit(1).cast("long")
    by_id = F.when(F.col("stays.no_id"), signed["doc"] == F.col("stays.doc"))
    return joined.select(
        "doc_id",
        "unnamed",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("class_id"),
        F.coalesce("class_size", one).alias("class_size"),
        F.coalesce("copies", one).alias("copies"),
        F.when(F.col("class").isNull(), True)
        .otherwise(by_id.otherwise(F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))))
        .alias("kept"),
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, copies (rows with the same words), kept of every document."""
    return _classes(docs, _unnamed(docs)).drop("unnamed")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each class, columns as they were."""
    unnamed = _unnamed(docs)
    kept = settle(_classes(docs, unnamed).where("kept").select("doc_id", "unnamed"), "kept")
    ids = kept.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("kept_id")).distinct()
    named = docs.join(ids, F.col("doc_id").cast("long") == F.col("kept_id"), "left_semi")
    return named.unionAll(unnamed.join(kept.select("unnamed"), "unnamed", "left_semi").select("row.*"))
