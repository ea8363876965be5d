import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from llm_texts import prose

from ledgerproof.llm import dartminhash as dm
from ledgerproof.llm.components import components


def multiset(text):
    words = regex.findall(r"[\p{L}\p{N}_']+", (text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes_by_hand(rows):
    """Components over all pairs of rows (doc_id, text) without null ids."""
    sets = [(i, multiset(t)) for i, t in rows]
    label = {n: n for n in range(len(sets))}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for n, (_, a) in enumerate(sets):
        for m in range(n):
            b = sets[m][1]
            if a and b and jaccard(a, b) >= dm.THRESHOLD:
                x, y = root(n), root(m)
                label[max(x, y)] = min(x, y)
    groups = {}
    for n in range(len(sets)):
        groups.setdefault(root(n), []).append(sets[n][0])
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=str)


def found(docs):
    got = dm.near_duplicates(docs).select("doc_id", "class_id", "class_size", "kept").collect()
    return sorted((tuple(r) for r in got), key=str)


def test_classes_by_brute_force(nasty, rows):
    assert found(nasty) == classes_by_hand([(r[0], r[1]) for r in rows])


def test_chains_and_boundaries(spark):
    """Texts that drift apart word by word: neighbours are alike, the ends are not."""
    rng = random.Random(4)
    rows, words = [], prose(rng, 120).split()
    for i in range(60):
        words = words.copy()
        words[rng.randrange(120)] = f"new{i}"
        rows.append((1000 - i, " ".join(words)))
    for i in range(30):  # about the threshold
        near = rows[i][1].split()
        for _ in range(rng.randint(1, 6)):
            near[rng.randrange(120)] = f"other{i}"
        rows.append((i, " ".join(near)))
    rows += [(5000 + i, prose(rng, rng.randint(1, 9))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == classes_by_hand(rows)


def test_whole_rows_stay(nasty, rows):
    kept = dm.without_near_duplicates(nasty)
    assert kept.columns == nasty.columns
    wanted = {r[0] for r in classes_by_hand([(r[0], r[1]) for r in rows]) if r[3]}
    assert {r.doc_id for r in kept.collect()} == wanted


def test_empty(empty):
    assert dm.near_duplicates(empty).count() == 0
    assert dm.without_near_duplicates(empty).columns == empty.columns


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    for overlap in (0.2, 0.5, 0.8, 0.95):
        a, b = [], []
        for element in rng.integers(1, 2**62, 300).astype(np.uint64):
            weight, other = rng.integers(1, 5), rng.integers(1, 5)
            a += [element] * weight
            b += [element] * (weight if rng.random() < overlap else other)
            if rng.random() > overlap:
                b += [element ^ np.uint64(1)] * other
        a, b = np.array(a, np.uint64), np.array(b, np.uint64)
        rng.shuffle(a)
        signed = dm.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert (signed != 0).all()
        wanted = dm.similarity(a, b)
        assert abs((signed[0] == signed[1]).mean() - wanted) < 4 * (wanted * (1 - wanted) / dm.COORDINATES) ** 0.5 + 0.01


def test_signature_does_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    docs = [rng.integers(1, 2**62, n).astype(np.uint64) for n in (0, 1, 2, 7, 300, 5000)]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    together = dm.signatures(np.concatenate(docs), bounds)
    for doc, signed in zip(docs, together, strict=True):
        assert (dm.signatures(doc, np.array([0, len(doc)]))[0] == signed).all()
    assert (together[0] == 0).all()


def test_components_by_brute_force(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(110)]
    rng.shuffle(edges)
    label = {n: n for e in edges for n in e}
    for _ in range(500):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.label for r in got.collect()} == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_linked_document_waits_for_one_that_was_screened_out(spark):
    """x is 0.06 from its leader and 0.198 from w, whose distance of 0.25 to the leader is estimated as 0.29."""
    n = 4000
    common = lambda s: round(2 * n * s / (1 + s))
    near, nearer = common(0.75), common(0.802)
    leader = list(range(n))
    w = leader[:near] + list(range(n, 2 * n - near))
    x = leader[: n - (nearer - near)] + w[near:nearer]
    tokens = [(1, leader), (2, x), (3, w)]
    runs = [dm.shingles(np.array(t), np.array([0, len(t)]))[0] for _, t in tokens]
    assert dm.similarity(runs[0], runs[2]) < dm.THRESHOLD <= dm.similarity(runs[1], runs[2])
    assert 1 - (dm.THRESHOLD - dm.MARGIN) - (1 - dm.THRESHOLD) > 1 - dm.similarity(runs[0], runs[1])
    sketch = lambda changed, by: [by if i < changed * dm.COORDINATES else 0 for i in range(dm.COORDINATES)]
    sketches = [(1, sketch(0, 0)), (2, sketch(0.06, 1)), (3, sketch(0.06, 1)[:31] + [2] * 118 + [0] * 363)]
    waiting = spark.createDataFrame([(7, 1), (7, 2), (7, 3)], "bucket long, doc long")
    sketches = spark.createDataFrame(sketches, "doc long, sketch array<tinyint>")
    links = dm._links(waiting, sketches, spark.createDataFrame(tokens, "doc long, tokens array<long>"))
    assert sorted(map(tuple, links.collect())) == [(1, 2), (3, 2)]


def test_rows_without_id_join_by_text_and_one_stays(spark):
    rng = random.Random(12)
    words = prose(rng, 150).split()
    near = [" ".join([*words[:n], "other", *words[n + 1 :]]) for n in (20, 90)]
    alone, same = prose(rng, 80), prose(rng, 60)
    rows = [(None, near[0]), (4, near[1])]  # near copies, not the same words
    rows += [(None, alone)] * 2 + [(None, alone + " tail"), (None, None), (None, same), (9, same)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = dm.near_duplicates(docs).where("kept")
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in kept.where("doc_id IS NOT NULL").collect()) == [(4, 4, 2), (9, 9, 2)]
    assert sorted(r.class_size for r in kept.where("doc_id IS NULL").collect()) == [1, 3]
    stay = [tuple(r) for r in dm.without_near_duplicates(docs).collect()]
    assert len(stay) == 4 and {(4, near[1]), (9, same), (None, None)} < set(stay)
    assert sum(i is None and t is not None and t.startswith(alone) for i, t in stay) == 1


def test_thinned_links_have_the_same_components(spark):
    rng = random.Random(4)
    links = [(leader, doc) for doc in range(100, 300) for leader in rng.sample(range(6), rng.randint(1, 5))]
    links += [(900 + leader, doc) for doc in range(400, 500) for leader in range(3)] + [(700, 701)]
    before = spark.createDataFrame(links, "a long, b long")
    after = dm._thinned(before)
    assert after.count() <= 301 + 6 * 5 + 2 < len(links)
    assert sorted(map(tuple, components(after).collect())) == sorted(map(tuple, components(before).collect()))


def test_joined_classes_are_those_of_all_links(spark):
    first, later = [(1, 2), (2, 3), (10, 11), (20, 21)], [(1, 20), (5, 10), (7, 9)]
    labels = components(spark.createDataFrame(first, "a long, b long"))
    joined = components(spark.createDataFrame(later, "a long, b long"))
    every = components(spark.createDataFrame(first + later, "a long, b long"))
    assert sorted(map(tuple, dm._merged(labels, joined).collect())) == sorted(map(tuple, every.collect()))


def test_signing_takes_little_memory_and_slices_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    offsets = np.concatenate([[0], np.cumsum([*rng.integers(0, 3, 20), *rng.integers(100, 500, 400), 9000])])
    tokens = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(rng.integers(0, 1 << 40, offsets[-1])))
    ids = pa.array(np.arange(len(tokens)))
    batch = pa.RecordBatch.from_arrays([ids, ids, tokens], ["doc_id", "unnamed", "tokens"])
    tracemalloc.start()
    signed = pa.Table.from_batches(list(dm._sign(iter([batch]))))
    assert tracemalloc.get_traced_memory()[1] < 60e6  # 270 MB in slices of 262,144 words
    tracemalloc.stop()
    monkeypatch.setattr(dm, "SLICE", 500)
    assert signed.to_pylist() == pa.Table.from_batches(list(dm._sign(iter([batch])))).to_pylist()


def test_documents_near_a_group_are_not_compared_with_all_of_it(spark, monkeypatch):
    """25 texts of 0.7 to 0.78 to a group of 60 met nearly all of its members."""
    rng = random.Random(3)
    base = prose(rng, 150).split()

    def changed(n, at):
        words = base.copy()
        for k, p in enumerate(rng.sample(range(5, 145, 6), n)):
            words[p] = f"new{at}x{k}"
        return " ".join(words)

    rows = [(i, changed(1, i)) for i in range(60)] + [(100 + i, changed(4 + i % 2, 100 + i)) for i in range(25)]
    pairs, screened = [], dm._screened

    def counted(these, sketches, least):
        if least > dm.NEAR:
            pairs.append(these.count())
        return screened(these, sketches, least)

    monkeypatch.setattr(dm, "_screened", counted)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == classes_by_hand(rows)
    assert sum(pairs) < 100


def test_runs_of_one_document_alone_bound_what_it_shares(spark):
    tokens = [(1, [*range(50)]), (2, [*range(46), 91, 92, 93, 94]), (3, [*range(30), *range(60, 80)]), (4, [7, 7, 7, 7, 7, 7]), (5, [7] * 7), (6, [])]
    tokens = spark.createDataFrame(tokens, "doc long, tokens array<long>")
    got = {r.doc: (r.runs, r.shared) for r in dm._hopeful(tokens.select("doc"), tokens).collect()}
    # 4 has two equal runs, 5 has three; of 3 only 26 runs of 46 stand elsewhere.
    assert got == {1: (46, 42), 2: (46, 42), 4: (2, 2)}
