import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessella.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", "tests", **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def split(spark, sf):
    """(train, test) of the small ratings table, kept for the whole session."""
    from tessella.operators.splits import parts, split_per_user
    from tessella.session import cut_lineage
    from tessella.sources import views

    return parts(cut_lineage(split_per_user(views.ratings(spark, sf))))
