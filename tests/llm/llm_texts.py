"""Random prose for the tests."""

import random

SYLLABLES = "the an er on th ing ed ha ti is re or st nd wh ou ea in he ly".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))
