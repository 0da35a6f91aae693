import pytest

#: Columns named like outputs or helper columns of the operators.
CLASHING = "_id long, _text string, n_words long, kept boolean, spans string, score double, n long, sid long, keys string, _row long, segment string, sequence_id long, fingerprint string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and blank texts, repeated rows and ids, a long text, clashing columns."""
    long_text = " ".join(f"word{i % 977}" for i in range(30_000)) + "\n" + "x" * 5000
    rows = [
        (0, "plain text of a few words"), (1, None), (2, ""), (3, " \t\n "), (4, "a"), (4, "a"), (4, "another text under the same id"),
        (None, "no id here"), (None, None), (5, long_text), (6, "é 漢字 😀 \x00 end"), (7, "plain text of a few words"),
    ]
    pad = [None] * 13
    return spark.createDataFrame([(i, t, "en", "src", None, *pad) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
