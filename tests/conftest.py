import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestrata.session import checkpoint_dir, get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app_name="lakestrata-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="lakestrata-test-", dir="/tmp")


def envelope_rows(spark, bodies, topic="t", ingest_date="2024-01-31", start_offset=0, partition=0):
    """Bronze envelope rows from raw body texts (offsets in list order)."""
    rows = [("2024-01-31T00:00:00.000000+00:00", topic, partition, start_offset + i, None, b, ingest_date)
            for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "bronze_ingest_time string, kafka_topic string, kafka_partition int, "
                                       "kafka_offset bigint, kafka_key string, raw_value string, ingest_date string")
