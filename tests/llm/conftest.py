"""Fixtures of the sample documents."""

from __future__ import annotations

import pytest
from samples import SCHEMA, rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
