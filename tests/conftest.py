import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hitlist.session import local_session

    # stage tables go to a scratch folder, as no shared one is configured here
    shared = tempfile.mkdtemp(prefix="hitlist-tests-")
    s = local_session("*", shuffle_partitions=8, app="hitlist-tests", more={"spark.checkpoint.dir": shared})
    yield s
    s.stop()


def chart_frame(spark, rows):
    """Raw chart rows: (Date, Rank, Song, Artist, Last Week, Peak Position, Weeks in Charts)."""
    from hitlist.schemas import CHART_RAW

    return spark.createDataFrame(rows, CHART_RAW)
