import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starbeam.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="starbeam-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    """The warehouse loaded from the smallest driver tables (once per test run)."""
    from starbeam.warehouse import fixture

    return fixture(spark, SMOKE)


@pytest.fixture(scope="session")
def star(fx):
    return fx.star
