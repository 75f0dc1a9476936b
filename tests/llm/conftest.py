import pytest

from dunlin.llm.common import let_workers_import

TEXT_SCHEMA = "doc_id bigint, text string, lang string, kept string, component_id int, spans int, mark string, row int"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    let_workers_import(spark)


@pytest.fixture
def frame(spark):
    """Documents with NULLs in any column and extra columns of clashing names."""

    def make(rows):
        return spark.createDataFrame([(i, t, None, "x", 1, 2, None, 3) for i, t in rows], TEXT_SCHEMA)

    return make
