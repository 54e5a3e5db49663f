"""Made-up words for the tests of this folder."""

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "to") for b in ("", "n", "rt", "sh", "lum")]


def prose(rng: random.Random, count: int) -> list[str]:
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(count)]
