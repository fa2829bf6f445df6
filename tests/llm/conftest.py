import pytest

from chatloom.llm.common import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)
