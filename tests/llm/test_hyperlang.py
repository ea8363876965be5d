import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from ledgerproof.llm import hyperlang
from ledgerproof.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def vectors_by_hand(text, letters, symbols):
    """The bundle of a text, one trigram at a time."""
    line = [0]
    for c in f"{text.lower()} ":
        s = int(symbols[ord(c)])
        if s or line[-1]:
            line.append(s)
    total = np.zeros(hyperlang.DIM)
    for a, b, c in zip(line, line[1:], line[2:]):
        if b:
            total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return total


def test_products_equal_bundled_vectors(nasty, rows):
    letters, symbols = hyperlang.letter_vectors(), hyperlang.symbol_table()
    train = [r for r in rows if r[1] and r[2]]
    prototypes = {}
    for lang in sorted({r[2] for r in train}):
        own = sum(vectors_by_hand(r[1], letters, symbols) for r in train if r[2] == lang and len(r[1]) < 3000)
        prototypes[lang] = own / np.linalg.norm(own)
    short = F.length("text") < 3000
    profiles = hyperlang.learn(nasty, short)
    assert profiles.languages == list(prototypes)
    texts = [r[1] for r in train[:25] if len(r[1]) < 3000]
    found, score = hyperlang.judge(texts, profiles)
    for text, lang, value in zip(texts, found, score, strict=True):
        bundle = vectors_by_hand(text, letters, symbols)
        if not bundle.any():
            assert lang == hyperlang.UNKNOWN
            continue
        dots = {k: bundle @ p for k, p in prototypes.items()}
        numbers, _ = hyperlang.trigrams([text], symbols)
        length = np.sqrt(hyperlang.DIM * (np.unique(numbers, return_counts=True)[1] ** 2).sum())
        assert abs(value - max(0, min(1, max(dots.values()) / length))) < 1e-3
        assert dots[lang] >= max(dots.values()) - 1e-2 * length


def test_defined_cases(nasty, empty, rows):
    profiles = hyperlang.learn(nasty, F.lit(True))
    got = hyperlang.identify(nasty, profiles, carry=nasty.columns)
    assert got.count() == len(rows)
    for r in got.select("row.text", "lang_pred", "score").collect():
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == blank and 0 <= r.score <= 1
        assert r.lang_pred in ("en", "fr", "und") and (not blank or r.score == 0)
    assert hyperlang.learn(empty, F.lit(True)) is None
    assert {r.lang_pred for r in hyperlang.identify(nasty, None).collect()} == {"und"}
    assert hyperlang.identify(empty, profiles).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op9_hyperdimensional_language"](spark, SF).join(docs, "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()


def test_profiles_of_many_trigrams_take_little_memory_and_are_the_sums_of_their_vectors():
    rng = np.random.default_rng(3)
    numbers = np.sort(rng.choice(hyperlang.TRIGRAMS, 9000, replace=False))
    times = rng.integers(1, 10**7, len(numbers))
    hyperlang.bundle({"x": (numbers[:9], times[:9])})
    tracemalloc.start()
    products = hyperlang.bundle({"x": (numbers, times)}).products
    assert tracemalloc.get_traced_memory()[1] < 80e6  # 206 MB with the vectors of 4096 trigrams at once
    tracemalloc.stop()
    letters = hyperlang.letter_vectors()
    bound = lambda n: np.roll(letters[n // 4096], 2) * np.roll(letters[n // 64 % 64], 1) * letters[n % 64]
    prototype = sum(np.float64(t) * bound(n) for n, t in zip(numbers, times, strict=True))
    prototype /= np.linalg.norm(prototype)
    assert all(abs(products[n, 0] - bound(n) @ prototype) < 1e-3 for n in numbers[:50])
