import pytest
from triplake.llm.queries import reach_workers

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture
def docs(spark):
    def make(*texts, first=1):
        rows = [(first + i, t, None, None, None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOC)

    return make


@pytest.fixture
def labels(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return make
