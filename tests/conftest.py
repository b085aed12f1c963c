from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricequarry.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, memory="4g")
    s.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    yield s


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    return SF


def clashing(df):
    """The table with further columns of the same names, and of names that differ in case."""
    from pyspark.sql import functions as F

    again = df.select("*", *[F.lit("other").alias(c) for c in df.columns], *[F.lit(1).alias(c.upper()) for c in df.columns])
    return again
