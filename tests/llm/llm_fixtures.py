"""Texts for tests."""

WORDS = "alder birch cedar dahlia elm fern gorse hazel iris juniper kelp larch maple nettle oak pine".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))
