from __future__ import annotations

import pytest
from llm_helpers import ROWS, SCHEMA


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in all columns, empty and long texts, repeated rows."""
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
