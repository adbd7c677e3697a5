import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tte.session import local_session

    s = local_session(cores=4, shuffle_partitions=8, app="tte-tests")
    yield s


@pytest.fixture
def frame(spark):
    import pandas as pd

    def make(**cols):
        return spark.createDataFrame(pd.DataFrame(cols))

    return make
