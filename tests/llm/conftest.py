from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture
def documents(spark: SparkSession):
    """Make a documents frame of (doc_id, text) rows with the usual columns."""

    def make(rows, extra: str = ""):
        frame = spark.createDataFrame(list(rows), "doc_id bigint, text string")
        return frame.selectExpr("*", "'en' AS lang", "'src' AS source", "length(text) AS n_chars", *filter(None, [extra]))

    return make
