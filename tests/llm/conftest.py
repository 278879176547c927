from __future__ import annotations

import pytest
from awkward import awkward_rows, frame


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def awkward(spark, rows):
    return frame(spark, rows).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
