import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from support import SF001, shown_settings  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    from ridemart.session import ensure_checkpoint_dir, get_spark

    s = get_spark("local[*]", app_name="ridemart-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def settings():
    return shown_settings()


@pytest.fixture(scope="session")
def inputs001(spark):
    from ridemart.plans.catalog import Inputs

    return Inputs(spark, SF001, shown_settings())


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
