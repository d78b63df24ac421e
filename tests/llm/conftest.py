import pytest

LONG = "palabra " * 60_000 + "fin\n" + "x" * 100_000
TEXTS = [None, "", " \t\n", "\n\n", "one", "One two three four five six.\nOne two three four five six.", LONG,
         "Released under the MIT License.\nall good", "naïve façade — ÉCOLE\r\nécole", "a\x00b", "12345 !!!",
         "the cat sat on the mat and the dog sat on the log " * 8]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 2}", 0) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "nothing known", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([r + (1, 2, "x", 0.5, 7, "h") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 "k1 long, fp long, line string, score double, row_id long, host string")


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
