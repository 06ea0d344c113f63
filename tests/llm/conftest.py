import pytest

from refinery.llm.queries import ready


@pytest.fixture(autouse=True)
def workers_find_the_library(spark):
    ready(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names clash with results."""

    def build(rows, **more):
        extra = "".join(f", {name} string" for name in more)
        values = [(*row, *more.values()) for row in rows]
        return spark.createDataFrame(values, f"doc_id bigint, text string{extra}")

    return build
