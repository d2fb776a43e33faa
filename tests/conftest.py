import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from giniflow.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_df(spark):
    from giniflow.session import materialize
    from giniflow.sources.fixture import scoring_sample
    return materialize(scoring_sample(spark, SF_SMALL), "fixture")      # stored, not cached: plans of other tests stay their own
