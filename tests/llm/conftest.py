import pytest

from sparkloom.llm import bpe

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n, seed=1):
    """n words in a fixed but irregular order."""
    out, x = [], seed
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x // 65536 % len(WORDS)] + (str(x % 97) if x % 3 == 0 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, ties, a repeated row, a long text, and columns with names that operators use."""
    long = prose(20_000, 9)
    rows = [
        (1, prose(80), "en"), (2, prose(80).upper(), "en"), (3, prose(80) + " end", None), (4, None, "en"), (5, "", "de"), (6, " \n\t ", "de"),
        (7, "Two words", "en"), (7, "Two words", "en"), (8, long, "fr"), (9, long, "fr"), (None, "no id here", "en"), (10, "é" * 50 + " ñandú", "es"),
    ]
    return spark.createDataFrame([(i, t, l, 1, "x", -3) for i, t, l in rows], "doc_id long, text string, lang string, kept int, h string, n long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def vocabulary():
    return bpe.vocabulary_path()
