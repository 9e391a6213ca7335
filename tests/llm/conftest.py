import pytest

from tidemark.llm.common import importable


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    importable(spark)
