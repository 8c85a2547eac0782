"""Texts and tables that the tests share."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def prose(rng, n):
    syllables = ["the", "an", "ti", "on", "er", "re", "sh", "ble", "wh", "ou", "ing", "ha"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))
