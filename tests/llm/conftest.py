import random

import pytest

WORDS = "the of and river stone market people window garden morning silver engine letter orange valley thunder".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


SHARED = prose(1, 40)

#: Nulls, empty, blank and short texts, ties, repeated rows, a null id, a very long text, marks of many bytes.
ROWS = [
    (1, prose(2, 60) + " " + SHARED + " " + prose(3, 30)),
    (2, prose(4, 50) + "\n" + SHARED),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "one"),
    (7, "é☃ ünïcode 'sure it's ＡＢＣ"),
    (8, prose(5, 120)),
    (8, prose(5, 120)),
    (9, prose(5, 119) + " changed"),
    (10, prose(6, 3000)),
    (11, "ab" * 300),
    (12, SHARED.upper()),
    (50, prose(5, 120)),
    (100, prose(7, 80) + " " + SHARED + "."),
    (None, prose(8, 70)),
    (None, prose(8, 70)),
]
CLASH = "row string, score double, _id long, kept string, size long, h string"


@pytest.fixture(scope="session")
def docs(spark):
    """The rows with source, lang and n_chars, and columns whose names the operators use themselves."""
    rows = [(i, t, "en", None if k % 5 == 4 else f"s{k % 3}", len(t) if t else 0, "r", 0.5, 7, "k", 1, "h") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}").repartition(3, "lang", "doc_id")


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
