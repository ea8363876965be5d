"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs. A trigram ``abc`` is bound as
``rot(rot(A)) * rot(B) * C``; a text is the sum (bundle) of its trigrams, and so is the
prototype of a language over all its training texts. A text gets the language whose
prototype has the largest cosine with it.

The bundle of a text is linear in its trigram counts, so its product with a prototype is
the sum of the products of its trigrams, and these are tabulated once: 64 letters give
64 ** 3 trigrams. The length of a bundle comes from the counts, for bound vectors of
different trigrams are orthogonal but for noise of one part in ``sqrt(DIM)``. What leaves
a task in training is one count per language and trigram at most, so the model's size is
bounded by the number of languages and not by the corpus.

Letters are lower-cased; each maps to one of 63 symbols by its code point, anything else
to a word break, of which runs count once. Cases: a null text or one without letters is
``und`` with score 0; without any training text all are ``und``; null languages teach
nothing; ties go to the smaller language name; an empty table gives an empty result; texts
are read whole; other columns are only carried, in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerproof.llm.common import packed, slices

DIM = 4096
SYMBOLS = 64
TRIGRAMS = SYMBOLS**3
SEED = 11
UNKNOWN = "und"


def symbol_table() -> np.ndarray:
    """Symbol by code point: 0 for what is no letter, else 1 to 63."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letter, np.arange(0x110000) % (SYMBOLS - 1) + 1, 0).astype(np.uint8)


def _text_list(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def trigrams(texts: Sequence[str], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers of all texts and, for each, the number of its text.

    Texts stand between word breaks; a trigram needs a letter in its middle.
    """
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    symbol = symbols[points].astype(np.int32)
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] != 0) | (symbol[:-1] != 0) | (owner[1:] != owner[:-1])
    symbol, owner = symbol[keep], owner[keep]
    a, b, c = symbol[:-2], symbol[1:-1], symbol[2:]
    inside = (b != 0) & (owner[:-2] == owner[2:])
    return ((a * SYMBOLS + b) * SYMBOLS + c)[inside], owner[1:-1][inside]


def letter_vectors(dim: int = DIM) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.float32([-1, 1]), (SYMBOLS, dim))


@dataclass
class Profiles:
    """Languages, each trigram's product with each unit-length prototype, the symbol table."""

    languages: list[str]
    products: np.ndarray  # TRIGRAMS x languages
    symbols: np.ndarray


def bundle(counts: dict[str, tuple[np.ndarray, np.ndarray]], dim: int = DIM) -> Profiles:
    """Profiles from (trigrams, counts) by language."""
    letters, languages = letter_vectors(dim), sorted(counts)
    products = np.zeros((TRIGRAMS, len(languages)), np.float32)
    middle, first = np.roll(letters, 1, 1), np.roll(letters, 2, 1)
    for i, language in enumerate(languages):
        numbers, times = counts[language]
        every = np.bincount(numbers, times, TRIGRAMS)
        # The sum over the bound vectors, letter by letter: no vector of a trigram is formed. Sums of whole numbers are exact.
        prototype = np.zeros(dim, np.float64)
        for a, of_a in enumerate(every.reshape(SYMBOLS, SYMBOLS, SYMBOLS)):
            prototype += first[a] * (middle * (of_a @ letters)).sum(0)
        prototype = (prototype / np.linalg.norm(prototype)).astype(np.float32)
        for a in range(SYMBOLS):  # all b and c at once
            bound = (first[a] * middle * prototype) @ letters.T
            products[a * SYMBOLS**2 : (a + 1) * SYMBOLS**2, i] = bound.ravel()
    return Profiles(languages, products, symbol_table())


def learn(docs: DataFrame, train: Column, dim: int = DIM) -> Profiles | None:
    """Prototypes from all rows where ``train`` holds; None without any."""
    symbols = docs.sparkSession.sparkContext.broadcast(symbol_table())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = _text_list(batch.column("text"))
            every = np.array(batch.column("lang").to_pylist(), dtype=object)
            for part in slices([len(t) for t in texts]):
                language, (numbers, owner) = every[part], trigrams(texts[part], symbols.value)
                for name in set(language):
                    own = np.bincount(numbers[(language == name)[owner]], minlength=TRIGRAMS)
                    sums[name] = sums[name] + own if name in sums else own
        for name, total in sums.items():
            used = np.flatnonzero(total)
            columns = [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "trigram", "times"])

    rows = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.select("lang", "text").mapInArrow(count, "lang string, trigram int, times long")
    # One row per language and trigram that occurs: bounded by languages x 64 ** 3.
    total = counted.groupBy("lang", "trigram").agg(F.sum("times").alias("times")).toArrow()
    names = np.array(total.column("lang").to_pylist(), dtype=object)
    numbers, times = total.column("trigram").to_numpy(), total.column("times").to_numpy()
    if not len(names):
        return None
    order = np.argsort(numbers, kind="stable")  # the same sums in each run
    names, numbers, times = names[order], numbers[order], times[order]
    return bundle({n: (numbers[names == n], times[names == n]) for n in set(names)}, dim)


def judge(texts: Sequence[str], profiles: Profiles, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Language and cosine, cut to 0 to 1, of each text."""
    numbers, owner = trigrams(texts, profiles.symbols)
    n, languages = len(texts), np.array([*profiles.languages, UNKNOWN], dtype=object)
    dots = np.stack(
        [np.bincount(owner, profiles.products[:, i][numbers], n) for i in range(len(profiles.languages))], 1
    )
    pairs, times = np.unique(owner.astype(np.int64) * TRIGRAMS + numbers, return_counts=True)
    length = np.sqrt(dim * np.bincount(pairs // TRIGRAMS, times.astype(np.float64) ** 2, n))
    cosine = dots / np.maximum(length, 1e-9)[:, None]
    best = np.where(length > 0, cosine.argmax(1), len(profiles.languages))
    score = np.where(length > 0, np.clip(cosine.max(1), 0, 1), 0.0)
    return languages[best].tolist(), score


def identify(docs: DataFrame, profiles: Profiles | None, *, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, lang_pred, score, ``row``: the language of each text, from the text alone."""
    rows = docs.select("doc_id", "text", packed(docs, carry))
    kinds = {f.name: f.dataType for f in rows.schema}
    if profiles is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), "row")
    shared = docs.sparkSession.sparkContext.broadcast((profiles.languages, profiles.products, profiles.symbols))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(*shared.value)
        for batch in batches:
            texts = _text_list(batch.column("text"))
            found = [judge(texts[part], known) for part in slices([len(t) for t in texts])]
            languages = pa.array([x for some, _ in found for x in some], pa.string())
            score = pa.array(np.concatenate([s for _, s in found] or [np.zeros(0)]))
            columns = [batch.column("doc_id"), languages, score, batch.column("row")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "row"])

    schema = (
        f"doc_id {kinds['doc_id'].simpleString()}, lang_pred string, score double,"
        f" row {kinds['row'].simpleString()}"
    )
    return rows.mapInArrow(predict, schema)
