from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows and ids, columns with names the operators use."""
    base = prose(1, 80)
    rows = [
        (1, base, "en", "a", 1, 0.5, "k"),
        (2, base, "en", "a", 1, 0.5, "k"),
        (2, base, "en", "a", 1, 0.5, "k"),
        (3, None, None, None, None, None, None),
        (4, "", "en", "a", 0, 0.1, ""),
        (5, " \t\n\x0b ", "en", "a", 5, 0.1, "x"),
        (None, base, "en", "a", 1, 0.2, "x"),
        (None, None, None, None, None, None, None),
        (6, prose(2, 60) + "\n" + "\n".join([prose(3, 12)] * 3), "en", "b", 2, 0.3, "x"),
        (7, prose(4, 30_000), "en", "b", 2, 0.3, "x"),
        (8, "x" * 3000, "en", "b", 2, 0.3, "x"),
        (9, "é漢字 ▁ \U0001f600 ok", "xx", "b", 2, 0.3, "x"),
        (9, "another text under the same id", "xx", "b", 2, 0.3, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, key string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
