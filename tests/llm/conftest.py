import pytest

TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h i j k",
    "Same words again\nSame words again\n\nSame words again", "x" * 5000, "# * $ % & | < > x y z",
    "Größe für Äpfel und Öl naïve café l'été don't we'll 12 345", "\U0001F600 emoji 中文 text ² ́mark",
    "w1 w2 w3 w4 w5 w1 w2 w3 w4 w5 end", " ".join(f"t{i % 7}" for i in range(400)), "na\x00ught \x0b vt \x0c ff \x1c fs",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and odd texts, repeated rows, clashing extra columns."""
    rows = [(i, t, "en", None, "own", -1, True) for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "en", None, "own", -1, True), (None, "null id text", None, None, None, None, None), (50, TEXTS[11], "en", "s", "x", 1, False)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _text string, n_words int, kept boolean")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("doc_id < -5")
