"""Made-up prose for the tests."""

WORDS = "amber birch cedar dune ember fjord grove heath inlet jetty knoll ledge moor notch oasis".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + k * k + k // 5) % len(WORDS)] + str((seed + k) % 11) for k in range(n))
