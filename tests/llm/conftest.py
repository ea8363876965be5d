"""Documents with all that may go wrong: nulls, empty and very long texts, copies, clashing columns."""

import random

import pytest
from llm_texts import prose

CLASHING = "row size taken score group tokens ids shard kept label words rest digit number copy found".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHING
)


def nasty_rows() -> list[tuple]:
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    texts: list[str | None] = [*base, None, None, "", "", "   ", "\n", "?!", "a", "A", "ÀÉ", "àé", "x" * 50_000]
    texts += [base[0].upper(), base[0], base[0] + " tail", base[1] + "\n", " " + base[1]]
    texts += [base[2]] * 15  # a hot group of copies
    for i in range(12):  # a group of near copies, all different
        words = prose(random.Random(9), 150).split()
        words[rng.randrange(150)] = f"changed{i}"
        texts.append(" ".join(words))
    texts += [prose(rng, 6000), "long line " * 4000, "naïve café 日本語 ▁ \t mixed\r\n 12345 😀 " * 3]
    texts += ["you are an idiot. " + prose(rng, 30), "he is not an idiot", "they said idiot"]
    texts += ['token = "0b96a8c8d79c4a5085c919698889f59b" ' + prose(rng, 20)]
    langs = ["en", "fr", None]
    sources = ["s1", "s0", None, "Z"]
    rows = []
    for i, text in enumerate(texts):
        source = "s1" if i % 3 == 0 else sources[i % 4]
        rows.append((i * 7, text, langs[i % 3], source, None, *["x"] * len(CLASHING)))
    rows.append(rows[3])  # the same row twice
    rows.append((None, base[5], "en", "s0", 1, *[None] * len(CLASHING)))
    rows.append((None, None, None, None, None, *[None] * len(CLASHING)))
    return rows


@pytest.fixture(scope="session")
def rows():
    return nasty_rows()


@pytest.fixture(scope="session")
def nasty(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
