import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts or (doc_id, text) pairs, with a column whose name clashes with inner ones."""

    def make(rows, partitions=3):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, None, "s", None if t is None else len(t), 7, "x") for i, t in pairs]
        return spark.createDataFrame(full, f"{DOCS}, n long, grp string").repartition(partitions)

    return make


#: Null, empty and blank texts, a very long one, repeated rows, a null id.
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "a b c " * 40000), (5, "same text here"), (5, "same text here"), (None, "same text here"), (None, None), (6, "é" * 30)]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def none(docs_of, spark):
    return docs_of([(1, "x")]).where("doc_id < 0")
