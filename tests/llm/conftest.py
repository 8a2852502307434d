import pytest
from rows import PROSE, table

@pytest.fixture(scope="session")
def prose():
    return PROSE


@pytest.fixture(scope="session")
def odd_rows():
    """Null id, null and empty text, no white space, one long line, repeated rows, ties, other white space."""
    long = " ".join(f"word{i % 911} and{i % 13}." for i in range(20_000))
    return [
        (1, PROSE), (2, PROSE), (3, PROSE.replace("heron", "stork")), (4, ""), (5, None), (None, PROSE + " More."),
        (None, None), (6, long), (7, "x" * 5000), (8, "a\tb  c\n\n d e é 漢字 \U0001f600"), (9, "one"),
        (9, "one"), (9, "two words"), (10, "|".join(["home ", " about ", " news "] * 30)), (11, "ab " * 700),
        (12, "Σ ǅ İ ß STRASSE straße"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return table(spark, odd_rows)


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])
