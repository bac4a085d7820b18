from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfmark.session import build_session  # noqa: E402

TESTDATA = os.environ.get("SHELFMARK_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shelfmark-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            # Default session behaviour, so that nothing relies on the settings
            # a delivery cluster would have.
            "spark.sql.caseSensitive": "false",
            "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def case_sensitive(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    yield
    spark.conf.set("spark.sql.caseSensitive", "false")


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA
