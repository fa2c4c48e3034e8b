"""Invented prose."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        w = rng.choice(WORDS) + rng.choice(WORDS)
        out.append(w.capitalize() + "." if i % 9 == 8 else w)
    return " ".join(out)
