import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
# Python workers (REST data source, stub transport) import from the repo too.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [REPO, os.path.join(REPO, "tests"), os.environ.get("PYTHONPATH", "")]).rstrip(os.pathsep)
sys.path.insert(0, REPO)

SF = os.environ.get("TRIBUTARY_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tributary.session import local_session

    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def responses(spark):
    def make(bodies, errors=None):
        rows = [(i, b, (errors or {}).get(i)) for i, b in enumerate(bodies)]
        return spark.createDataFrame(rows, "seq bigint, body string, error string")
    return make
