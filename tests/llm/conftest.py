"""Small awkward tables: nulls, blanks, long texts, ties, repeats, clashing column names."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_rows import SCHEMA, full, odd_documents  # noqa: E402


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(full(odd_documents()), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
