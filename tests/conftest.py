import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from catalog_lake.session import get_spark
    s = get_spark("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def cat(spark):
    from catalog_lake.binding import Catalog
    return Catalog(spark, SF_SMALL)


@pytest.fixture()
def tmpdir_path(tmp_path):
    return str(tmp_path)
