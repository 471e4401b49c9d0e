import pytest
from llm_cases import EDGE, documents


@pytest.fixture(scope="session")
def edge(spark):
    return documents(spark, EDGE).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
