import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tokenizers

from ledgerproof.llm import packing


def documents_by_hand(rows):
    library = tokenizers.Tokenizer.from_file(packing.VOCABULARY)
    return [(r[0], [*library.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in rows]


def check(got, documents, capacity):
    """Every piece is there once, as cut, and the sequences have neither gaps nor too many tokens."""
    wanted = []
    for doc_id, ids in documents:
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            data = np.array(ids[a:b], "<u4").tobytes()
            wanted.append((doc_id, n, a, b - a, zlib.crc32(data)))
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(w[3] for w in wanted) // capacity)


@pytest.mark.parametrize("capacity,leaf,slack", [(2048, 32_768, 4), (64, 7, 0), (64, 40, 4), (1, 5, 0)])
def test_pieces_and_sequences(nasty, rows, capacity, leaf, slack):
    if capacity == 1:
        rows = [r for r in rows if len(r[1] or "") < 100]
        nasty = nasty.where("length(coalesce(text, '')) < 100")
    got = packing.pack(nasty, capacity=capacity, leaf=leaf, fan=2, slack=slack).collect()
    n, bound = check(got, documents_by_hand(rows), capacity)
    assert n <= bound * 1.2 + 1


def test_leaves_lose_little(spark):
    rng = random.Random(4)
    rows = [(i, " a" * min(int(rng.expovariate(1 / 40)), 500)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(docs, capacity=128, leaf=100, fan=4).collect()
    n, bound = check(got, documents_by_hand(rows), 128)
    whole = len(packing.best_fit(np.array([r.length for r in got]), 128)[2])
    assert bound <= whole <= n <= whole * 1.01 + 1


def test_what_fits_nowhere_ends_the_tree(spark):
    docs = spark.createDataFrame([(i, " a" * 70) for i in range(400)], "doc_id long, text string")
    got = packing.pack(docs, capacity=128, leaf=20, fan=2).collect()
    assert len({r.sequence_id for r in got}) == 400


def best_fit_by_hand(sizes, capacity):
    rooms, placed = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in rooms if r >= sizes[i]]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - sizes[i])
        placed[i] = room
    return sorted(rooms), placed


def test_best_fit_by_hand():
    rng = random.Random(7)
    for _ in range(200):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 60))]
        sequence, at, fills = packing.best_fit(np.array(sizes), 20)
        rooms, placed = best_fit_by_hand(sizes, 20)
        assert sorted(20 - f for f in fills) == rooms
        assert [20 - a for a in at] == [placed[i] for i in range(len(sizes))]
        assert np.array_equal(np.bincount(sequence, weights=sizes), fills)


def test_empty(empty):
    assert packing.pack(empty).count() == 0
