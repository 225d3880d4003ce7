import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    # tests only: a fresh scratch checkpoint folder (clusters set spark.checkpoint.dir)
    ckpt = tempfile.mkdtemp(prefix="daybook-test-ckpt-")
    session = local_session(shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt,
                                                          "spark.sql.warehouse.dir": f"{ckpt}/warehouse"})
    yield session


@pytest.fixture(scope="session")
def duck():
    from daybook.plans.verify import duck as connect

    return connect(SF)


def rows(df):
    """Rows as a sorted list of tuples (order-insensitive comparison)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
