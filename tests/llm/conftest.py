import pytest

from chartloom.llm.ship import ship


@pytest.fixture(scope="session")
def llm(spark):
    """Session whose Python workers know the package."""
    return ship(spark)


@pytest.fixture
def frame(llm):
    """DataFrame from tuples and a schema text, over a few partitions."""
    return lambda data, schema: llm.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def word_bpe():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(frame):
    """Documents from (id, text), with columns whose names clash with those used inside."""
    return lambda rows: frame([(i, t, 7, "x", 1.5) for i, t in rows], "doc_id long, text string, id int, n string, __text double")
