from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"

#: Rows that every operator has to take: nulls, empty, white space, repeats, a long text.
TRICKY = [
    (1, "One two three four five six seven eight nine ten.", "en", "a"),
    (1, "One two three four five six seven eight nine ten.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \n\t ", "de", "b"),
    (5, "word " * 60_000, "en", "a"),
    (None, "a text without an id, twice said", "en", None),
    (None, "a text without an id, twice said", "en", None),
    (7, "Ein zweiter  Text\nmit Zeilen\nmit Zeilen", "de", "b"),
    (8, "naïve café 日本語 \U0001F600", "fr", "a"),
]
#: Columns of other tables whose names the operators use inside.
EXTRA = ("score", "label", "kept", "n_words", "position", "length", "ids", "_salt", "fingerprint",
         "digest", "spans", "stem", "tie", "windows", "phrases", "_uid", "_doc", "_tie", "_score", "_best",
         "kind", "root", "h", "extra_0", "key", "best", "component", "t1")


@pytest.fixture(scope="session")
def tricky(spark):
    """The tricky rows, with extra columns of clashing names."""
    rows = [r + (len(r[1] or ""),) + tuple(f"x{i}" for i in range(len(EXTRA))) for r in TRICKY]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(None, 1, 0), (2, None, None), (2, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF).exists():
        pytest.skip("no test data")
    return SF
