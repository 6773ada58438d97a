import random

import pytest

#: Names that the operators use inside.
CLASHING = [
    "key", "ids", "n", "n_tokens", "task", "rank", "whole", "tail", "base", "added", "row", "rid", "fp", "root", "id",
    "component_id", "carried", "toxicity", "is_toxic", "quality", "is_good", "spread", "part", "block", "start", "decoded",
]


def sentence(rnd, n):
    words = "the of and house river stone green walk light paper window seven orange table music forest".split()
    return " ".join(rnd.choice(words) + str(rnd.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    rnd = random.Random(3)
    long_text = "\n".join(sentence(rnd, 12) + "." for _ in range(2500))
    same = sentence(rnd, 60)
    return [
        (1, None), (2, ""), (None, "a text without an id, call +1 (917) 555-2670 now"), (3, long_text), (4, same), (4, same),
        (5, same), (6, " \n\t "), (7, "one"), (8, "é ñ ü 日本語 😀 a@b.co"), (None, None), (9, "x" * 50_000),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """Odd documents, with extra columns whose names clash."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    rows = [(i, t, None, None, None if t is None else len(t), *["?"] * len(CLASHING)) for i, t in odd_rows]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
