import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forecourt.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.sql.maxMetadataStringLength": "10000", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="forecourt-tests-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="forecourt-test-")
