import pytest
from larkspur.llm.common import share_package
from llm_data import ODD


@pytest.fixture(autouse=True, scope="session")
def workers_find_the_package(spark):
    share_package(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table."""
    def make(rows, partitions=3):
        return spark.createDataFrame(
            [(i, t, "en" if (i or 0) % 2 else None, f"src{(i or 0) % 3}", 5) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        ).repartition(partitions)
    return make


@pytest.fixture
def odd(docs):
    return docs(ODD)
