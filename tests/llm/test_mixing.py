import random
import re
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from ledgerproof.llm import mixing


def test_sainte_lague_equals_seat_by_seat():
    rng = random.Random(1)
    for _ in range(60):
        weights = [Fraction(rng.randint(0, 50)) for _ in range(rng.randint(1, 9))]
        seats = rng.randint(0, 80)
        won = [0] * len(weights)
        for _ in range(seats if sum(weights) else 0):
            best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
            won[best] += 1
        assert mixing.sainte_lague(weights, seats) == won


def test_targets_share_all_and_stop_at_three_times():
    targets = mixing.share_out([10, 1000, 0, 5], [1, 1, 2, 3], 1015)
    assert targets == [30, 970, 0, 15]
    assert mixing.share_out([], [], 0) == []
    assert mixing.share_out([0, 0], [1, 2], 0) == [0, 0]


def by_hand(placed, targets_of):
    """Taken words and copies by cutting every shard into its blocks, one word at a time."""
    out = {}
    for (_, _), docs in placed.items():
        docs = sorted(docs, key=lambda d: d["start"])
        total, quota = sum(d["size"] for d in docs), docs[0]["quota"]
        if not total:
            continue
        blocks = max(1, int(total / mixing.BLOCK_WORDS + 0.5))
        turn = docs[0]["turn"]
        times = [
            ((j + turn) % blocks + 1) * quota // blocks - ((j + turn) % blocks) * quota // blocks for j in range(blocks)
        ]
        assert sum(times) == quota
        upto = lambda x: sum(
            Fraction(times[j]) * max(0, min(Fraction(x), Fraction((j + 1) * total, blocks)) - Fraction(j * total, blocks))
            for j in range(blocks)
        )
        rounded = lambda x: int(upto(x) + Fraction(1, 2))
        for d in docs:
            end = d["start"] + d["size"]
            middle = (d["start"] + end) // 2 * blocks // total
            out[d["key"]] = (
                rounded(end) - rounded(d["start"]),
                times[middle] if d["size"] else 0,
            )
    return out


def test_mix_by_brute_force(spark, nasty, rows):
    mixed = mixing.mix(nasty, shard_docs=20).drop("row")
    again = mixing.mix(nasty.repartition(7), shard_docs=20).drop("row")
    order = ["doc_id", "size", "source", "start"]
    assert mixed.orderBy(*order).collect() == again.orderBy(*order).collect()
    got = mixed.collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    budget = sum(sizes.values())
    targets = dict(zip(names, mixing.share_out([sizes[n] for n in names], [1, 2, 3, 1], budget), strict=True))
    assert names[-1] is None and sum(targets.values()) == budget
    turns = {
        (i, s): h
        for i in range(len(names))
        for s, h in (
            (r.s, r.h)
            for r in spark.range(20)
            .select(F.col("id").alias("s"), F.xxhash64(F.lit(7), F.lit(i), F.col("id")).alias("h"))
            .collect()
        )
    }
    placed = defaultdict(list)
    for k, r in enumerate(got):
        assert r.source_size == sizes[r.source] and abs(r.target - float(targets[r.source])) < 1e-6
        number = names.index(r.source)
        placed[number, r.shard].append({**r.asDict(), "key": k, "hash": turns[number, r.shard]})
    for docs in placed.values():
        total = sum(d["size"] for d in docs)
        for d in docs:
            d["turn"] = d["hash"] % max(1, int(total / mixing.BLOCK_WORDS + 0.5))
    wanted = by_hand(placed, targets)
    for k, r in enumerate(got):
        assert (r.taken, r.copies) == wanted.get(k, (0, 0))
        assert 0 <= r.taken <= 3 * r.size
    for name in names:
        taken = sum(r.taken for r in got if r.source == name)
        assert abs(taken - targets[name]) <= max(2 * mixing.BLOCK_WORDS, 0.1 * float(targets[name]))


def test_shard_quotas_are_sainte_lague(nasty):
    got = mixing.mix(nasty, shard_docs=5).select("source", "shard", "quota", "size").collect()
    by_source = defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for r in got:
        by_source[r.source][r.shard][0] += r.size
        by_source[r.source][r.shard][1] = r.quota
    for shards in by_source.values():
        parts = [shards[s] for s in sorted(shards) if shards[s][0]]
        seats = sum(q for _, q in parts)
        limit = [3 * max(1, int(t / mixing.BLOCK_WORDS + 0.5)) for t, _ in parts]
        free = [(t, q) for (t, q), most in zip(parts, limit, strict=True) if q < most]
        if len(free) == len(parts):
            assert mixing.sainte_lague([Fraction(t) for t, _ in parts], seats) == [q for _, q in parts]


def test_whole_documents_and_empty(nasty, empty):
    whole = mixing.mixed_documents(nasty)
    assert whole.columns == nasty.columns
    assert set(whole.select("doc_id").collect()) <= set(nasty.select("doc_id").collect())
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(empty).columns == empty.columns


def test_small_and_mostly_empty_sources_reach_their_targets(spark):
    rows = [(0, "a " * 30, "few")] + [(i, "b " * 4 if i % 40 == 0 else None, "sparse") for i in range(1, 40_001)]
    rows += [(50_000 + i, "c " * 500, "z") for i in range(40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), lambda names: [3, 2, 1], shard_docs=100)
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 0.05 * r.target


def test_rows_that_share_id_and_size_are_documents_of_their_own(spark):
    """Sources of rows without id, and of one row repeated, are taken like others and from all shards."""
    rows = [(None, "a b c d e", "noid")] * 4000 + [(7, "x " * 20, "same")] * 5000
    rows += [(i, "c " * 30, "plain") for i in range(100, 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs, lambda names: [1, 1, 1], shard_docs=500)
    per_source = got.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("shard").alias("shard"), F.sum("size").alias("size")
    )
    for r in per_source.collect():
        assert abs(r.taken - r.target) <= 2 * mixing.BLOCK_WORDS, r
        assert r.shard >= 5
    places = got.where("source = 'same'").groupBy("shard", "start").count()
    assert places.where("count > 1").isEmpty() and places.count() == 5000
    biggest = got.where("source = 'same'").groupBy("shard").count().agg(F.max("count")).first()[0]
    assert biggest < 1000
    again = mixing.mix(docs.repartition(3), lambda names: [1, 1, 1], shard_docs=500)
    columns = ["source", "doc_id", "shard", "start", "taken"]
    assert got.select(columns).exceptAll(again.select(columns)).isEmpty()
    copies = mixing.mixed_documents(docs, weights=lambda names: [1, 1, 1], shard_docs=500).groupBy("source").count()
    assert all(r["count"] > 100 for r in copies.collect())
