import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    return local_session("8", partitions=4, folder=tempfile.mkdtemp(prefix="run-", dir="/tmp"))


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def src(spark, sf_dir):
    from tidemark.sources.fixtures import fixture_sources

    return fixture_sources(spark, sf_dir)
