import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    yield s


def ms_rows(spark, rows, schema, ts_fields=()):
    """Build a DataFrame from literal rows whose ``ts_fields`` are epoch milliseconds."""
    from pyspark.sql import functions as F

    from tidepool.functions.timecols import ntz_from_millis

    df = spark.createDataFrame(rows, schema)
    for f in ts_fields:
        df = df.withColumn(f, ntz_from_millis(F.col(f)))
    return df
