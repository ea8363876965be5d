"""Audit of how far the sources of a language differ in their words.

Each task counts the terms of its documents and gives one row per language and term: a
64-bit digest, the number of documents, and, packed, the counts by source. These rows are
dealt out and ordered by digest; a term's string rides along in its task's one row, as the
smallest and the largest that the task has met. Where both agree over all rows of a digest, it is
one term. Where not, terms collided: the digest is split by string into numbers (``split``)
beside it. What follows holds digests only: shares, pairs of sources and ranks. The text is
joined back for the rows that are returned, and for those that tie with the last of them.

All pairs of sources of a language are compared without building all terms for each: a source
that lacks a term has the same share for all terms that it lacks. The sum for a pair is then
one product for the terms that both lack, sums over each source's distinct counts, and a
correction for the terms that both hold. Only the last needs terms; a task adds it up over
many terms before anything leaves it.

All figures are whole numbers. Cases: null text, language and source are ''; a group
without terms takes part with shares of its own; a language without kept terms has pairs of
value 0; ties go by the UTF-8 of the item; repeated rows and rows without id are documents of
their own; very long texts are counted like others; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerproof.llm.bytebpe import column_bytes
from ledgerproof.llm.common import settle, slices

LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP = 200
SLICE = 1 << 23
ROWS = 1 << 17
PAIRS = 1 << 20
# What a byte of a text becomes: A-Z lower-cased, bytes of no term blank.
BYTES = np.zeros(256, np.uint8)
BYTES[128:] = np.arange(128, 256)
BYTES[97:123] = BYTES[65:91] = np.arange(97, 123)

Digest = Callable[[Column], Column]


def terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of texts without nulls, one after the other, and the text of each."""
    data, bounds = column_bytes(texts)
    data = BYTES[data]
    inside = data > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    fresh = bounds[:-1][np.diff(bounds) > 0]
    begins[fresh] = inside[fresh]  # a text's first term does not go on from the text before
    places = np.flatnonzero(begins)
    letters = data[inside]
    # Places among the bytes that are left when the blanks are taken out.
    starts = np.cumsum(inside, dtype=np.int32)[places] - 1
    cuts = np.append(starts, len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)])
    return words.dictionary_encode(), np.searchsorted(bounds, places, side="right") - 1


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(changed)


def packed_counts(sizes: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of (number, count) pairs as bytes; ``sizes`` pairs a row."""
    pairs = np.stack([numbers, counts], axis=1).astype("<u4")
    cuts = np.concatenate([[0], np.cumsum(sizes * 8)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(cuts), pa.py_buffer(pairs)])


def counted_terms(docs: DataFrame) -> DataFrame:
    """lang, term, documents, counts (packed by source number): one row per task's slice, language and term."""
    slice_size = SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(pc.binary_length(batch.column("text")).to_pylist(), slice_size):
                rows = batch.slice(part.start, part.stop - part.start)
                words, doc = terms(rows.column("text"))
                if not len(words):
                    continue
                langs, size = rows.column("lang").dictionary_encode(), len(words.dictionary)
                in_docs, times = np.unique(doc * size + words.indices.to_numpy(), return_counts=True)
                of_doc, code = in_docs // size, in_docs % size
                unit = langs.indices.to_numpy()[of_doc].astype(np.int64) * size + code
                number = rows.column("number").to_numpy()[of_doc]
                order = np.lexsort((number, unit))
                unit, number = unit[order], number[order]
                entry, firsts = runs(unit, number), runs(unit)
                sizes = np.diff(np.append(np.searchsorted(entry, firsts), len(entry)))
                which = unit[firsts]
                columns = [
                    langs.dictionary.take(pa.array(which // size)),
                    words.dictionary.take(pa.array(which % size)),
                    pa.array(np.diff(np.append(firsts, len(unit)))),
                    packed_counts(sizes, number[entry], np.add.reduceat(times[order], entry)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "documents", "counts"])

    return docs.mapInArrow(run, "lang string, term string, documents long, counts binary")


def splits(run: np.ndarray, term: pa.DictionaryArray) -> np.ndarray:
    """0 for rows of a digest with one string; else the place of the row's string among those of its digest."""
    code = term.indices.to_numpy()
    firsts = np.searchsorted(run, np.arange(run[-1] + 1))
    met = np.minimum.reduceat(code, firsts) != np.maximum.reduceat(code, firsts)
    split = np.zeros(len(run), np.int64)
    rows = np.flatnonzero(met[run])
    if len(rows):
        texts = [t.encode() for t in term.dictionary.take(pa.array(code[rows])).to_pylist()]
        place = {x: i for i, x in enumerate(sorted(set(zip(run[rows].tolist(), texts, strict=True))))}
        overall = np.array([place[x] for x in zip(run[rows].tolist(), texts, strict=True)])
        least = np.full(run[-1] + 1, len(place))
        np.minimum.at(least, run[rows], overall)
        split[rows] = overall - least[run[rows]] + 1
    return split


def kept_terms(counted: DataFrame, least: int) -> DataFrame:
    """lang, digest, split, term, n, numbers, counts of the terms in at least ``least`` documents."""
    most = ROWS

    def whole(rows: pa.Table) -> pa.RecordBatch:
        """Rows of complete digests, summed up by term."""
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        term = rows.column("term").combine_chunks().dictionary_encode()
        digest = rows.column("digest").to_numpy()
        firsts = runs(digest, langs.indices.to_numpy())
        run = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(digest))))
        split = splits(run, term)
        order = np.lexsort((split, run)) if split.any() else np.arange(len(run))
        unit = runs(run[order], split[order])
        enough = np.add.reduceat(rows.column("documents").to_numpy()[order], unit) >= least
        sizes = np.diff(np.append(unit, len(run)))
        kept = order[np.repeat(enough, sizes)]
        sizes, first = sizes[enough], order[unit[enough]]
        packed = rows.column("counts").combine_chunks().take(pa.array(kept))
        data, cuts = column_bytes(packed)
        pairs = data.view("<u4").reshape(-1, 2)
        of = np.repeat(np.repeat(np.arange(len(sizes)), sizes), np.diff(cuts) // 8)
        sorted_ = np.lexsort((pairs[:, 0], of))
        of, number, n = of[sorted_], pairs[sorted_, 0].astype(np.int64), pairs[sorted_, 1].astype(np.int64)
        entry = runs(of, number)
        n = np.add.reduceat(n, entry) if len(entry) else n
        ends = np.concatenate([[0], np.cumsum(np.bincount(of[entry], minlength=len(sizes)))]).astype(np.int32)
        total = np.add.reduceat(n, ends[:-1]) if len(sizes) else n
        columns = {
            "lang": langs.dictionary.take(langs.indices.take(pa.array(first))),
            "digest": pa.array(digest[first]),
            "split": pa.array(split[first].astype(np.int32)),
            "term": term.dictionary.take(term.indices.take(pa.array(first))),
            "n": pa.array(total),
            "numbers": pa.ListArray.from_arrays(ends, pa.array(number[entry])),
            "counts": pa.ListArray.from_arrays(ends, pa.array(n)),
        }
        return pa.RecordBatch.from_pydict(columns)

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < most:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            # The last digest may go on in the next batch.
            firsts = runs(rows.column("digest").to_numpy(), rows.column("lang").combine_chunks().dictionary_encode().indices.to_numpy())
            if firsts[-1]:
                yield whole(rows.slice(0, firsts[-1]))
            held = rows.slice(firsts[-1]).to_batches()
        if sum(b.num_rows for b in held):
            yield whole(pa.Table.from_batches(held).combine_chunks())

    dealt = counted.repartition("lang", "digest").sortWithinPartitions("digest", "lang")
    return dealt.mapInArrow(
        run_, "lang string, digest long, split int, term string, n long, numbers array<long>, counts array<long>"
    )


def share(count: Column, total: Column, kinds: Column) -> Column:
    """A term's share of a group with ``total`` occurrences of ``kinds`` kept terms."""
    whole = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    large = F.call_function("div", whole, (total + kinds).cast("decimal(19,0)"))
    small = F.call_function("div", (count + 1) * F.lit(SCALE).cast("long"), total + kinds)
    # A product of counts of this size still is a long.
    return F.when(count < 9 * SCALE, small).otherwise(large) + 1


def gain(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, a, b, value: what the terms that two sources hold add to their pair's sum, per batch."""

    def gains(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    for batch in batches:
        held = batch.column("held")
        cuts = held.offsets.to_numpy().astype(np.int64)
        inner = held.values
        own, p, none = (inner.field(f).to_numpy().astype(np.int64) for f in ("number", "p", "none"))
        top = int(own.max(initial=0)) + 1
        sizes = np.diff(cuts)
        row = np.repeat(np.arange(len(held)), sizes)
        # Each entry meets all of its term, so a run of entries has a known number of meetings.
        entries = np.arange(cuts[0], cuts[-1])
        for part in slices(sizes[row].tolist(), PAIRS):
            here = entries[part]
            n = sizes[row[part]]
            left = np.repeat(here, n)
            right = np.repeat(cuts[row[part]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            apart = left != right
            left, right = left[apart], right[apart]
            if not len(left):
                continue
            value = gains(p[left], p[right]) - gains(p[left], none[right])
            value += gains(none[left], none[right]) - gains(none[left], p[right])
            langs = batch.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy()[row[left - cuts[0]]].astype(np.int64)
            which, keys = pd.factorize((lang * top + own[left]) * top + own[right])
            sums = exact_sums(which, value, len(keys))
            columns = [langs.dictionary.take(pa.array(keys // top**2)), pa.array(keys // top % top), pa.array(keys % top), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])


def exact_sums(which: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of long values by place: of 21 bits at a time, which floats add up without error."""
    low = (1 << 21) - 1
    parts = (values & low, values >> 21 & low, values >> 42)
    sums = [np.bincount(which, weights=p, minlength=n).astype(np.int64) for p in parts]
    return sums[0] + (sums[1] << 21) + (sums[2] << 42)


def _pair_values(groups: DataFrame, kept: DataFrame, alike: DataFrame) -> DataFrame:
    """lang, source, item, value of all ordered pairs of sources of a language."""
    # One entry per source of the language, which is what the result asks for.
    entry = F.struct("number", "source", "total", "kinds", "none")
    others = groups.groupBy("lang").agg(F.array_sort(F.collect_list(entry)).alias("others"))
    pairs = groups.join(others, "lang").withColumn("o", F.explode("others")).where("o.number <> number")
    base = pairs.select(
        "lang", F.col("number").alias("a"), F.col("o.number").alias("b"),
        (F.col("kinds") * gain(F.col("none"), F.col("o.none"))).alias("value"),
    )
    met = alike.join(others, "lang").withColumn("o", F.explode("others")).where("o.number <> number")
    p, none, other = F.col("p"), F.col("none"), F.col("o.none")
    both_ways = F.array(
        F.struct(F.col("number").alias("a"), F.col("o.number").alias("b"), (gain(p, other) - gain(none, other)).alias("v")),
        F.struct(F.col("o.number").alias("a"), F.col("number").alias("b"), (gain(other, p) - gain(other, none)).alias("v")),
    )
    single = met.select("lang", "m", F.explode(both_ways).alias("w")).select(
        "lang", "w.a", "w.b", (F.col("m") * F.col("w.v")).alias("value")
    )
    # Source numbers run from 1, in the order of the list.
    group = lambda e: F.get("others", e["numbers"].cast("int") - 1)
    held = F.transform(
        F.arrays_zip("numbers", "counts"),
        lambda e: F.struct(
            e["numbers"].alias("number"),
            share(e["counts"], group(e)["total"], group(e)["kinds"]).alias("p"),
            group(e)["none"].alias("none"),
        ),
    )
    shared = kept.where("size(numbers) > 1").select("lang", "numbers", "counts").join(others, "lang")
    joint = shared.select("lang", held.alias("held")).mapInArrow(_corrections, "lang string, a long, b long, value long")
    sums = base.unionByName(single).unionByName(joint).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    named = lambda side, name: groups.select("lang", F.col("number").alias(side), F.col("source").alias(name))
    return sums.join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"])


def _top_terms(occurrences: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value of each group's ``top`` terms above the language's share."""
    group = ["lang", "source"]
    found = occurrences.where("p > q").withColumn("value", gain(F.col("p"), F.col("q")))
    # The least value that may be returned, from how often each value occurs.
    values = found.groupBy(*group, "value").agg(F.count("*").alias("times"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value")))
    values = values.withColumn("place", place).where(F.col("place") <= top)
    before = F.sum("times").over(Window.partitionBy(*group).orderBy(F.desc("value"))) - F.col("times")
    least = values.withColumn("before", before).where(F.col("before") < top)
    least = least.groupBy(*group).agg(F.min("value").alias("least"))
    candidates = found.join(least, group).where("value >= least").select(*group, "digest", "split", "value")
    texts = kept.select("lang", "digest", "split", F.col("term").alias("item"))
    return candidates.join(texts, ["lang", "digest", "split"]).select(*group, "item", "value")


def audit(
    docs: DataFrame, *, least: int = LEAST_DOCUMENTS, top: int = TOP, digest: Digest = F.xxhash64
) -> DataFrame:
    """lang, source, part, item, value, rank: the sources that differ from each, and its own terms."""
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    numbered = settle(
        plain.select("lang", "source").distinct().withColumn("number", place.cast("long")), "term-sources"
    )
    # Spark sends the written list of sources to the texts if it is small enough.
    counted = counted_terms(plain.join(numbered, ["lang", "source"]).select("text", "lang", "number"))
    kept = settle(kept_terms(counted.withColumn("digest", digest(F.col("term"))), least), "kept-terms")
    single = kept.select("lang", "digest", "split", F.col("n").alias("lang_n"), F.explode(F.arrays_zip("numbers", "counts")).alias("e"))
    single = single.select("lang", "digest", "split", "lang_n", F.col("e.numbers").alias("number"), F.col("e.counts").alias("n"))
    by_count = settle(single.groupBy("lang", "number", "n").agg(F.count("*").alias("m")), "term-histogram")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("n").alias("lang_total"))
    totals = by_count.groupBy("lang", "number").agg(F.sum(F.col("n") * F.col("m")).alias("total"))
    groups = numbered.join(langs, "lang", "left").join(totals, ["lang", "number"], "left")
    groups = groups.na.fill(0, ["kinds", "lang_total", "total"])
    # Without kept terms nothing has a share; the divisor only has to be there.
    room = F.greatest(F.col("kinds"), F.lit(1))
    groups = settle(groups.withColumn("none", share(F.lit(0), F.col("total"), room)), "term-groups")
    own = share(F.col("n"), F.col("total"), F.col("kinds")).alias("p")
    alike = by_count.join(groups, ["lang", "number"]).select("lang", "number", "m", "none", own)
    occurrences = single.join(groups, ["lang", "number"]).select(
        "lang", "source", "digest", "split", own, share(F.col("lang_n"), F.col("lang_total"), F.col("kinds")).alias("q")
    )
    pairs = _pair_values(groups, kept, alike).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    parts = pairs.unionByName(
        _top_terms(occurrences, kept, top).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = parts.withColumn("rank", rank)
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
