import pytest

TEXTS = [
    "The cat sat on the mat and the dog ran off to the far hills again",
    "The cat sat on the mat and the dog ran off to the far hills again",
    "", None, " \n\t ", "a", "Über straße, l'été! 你好 <|endoftext|> x", "dup line\ndup line\nother\n\ndup line", "w " * 3000, "long" * 4000, "One. Two! three?\r\n12 345",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names the operators use inside."""
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "b", "a", "é"][i % 4], None, i, i, i, i, i) for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, "null id text here", "en", "a", 1, 1, 1, 1, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long, length long, size long, label long, fp long")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
