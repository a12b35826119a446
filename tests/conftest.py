import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farelake.session import local_session  # noqa: E402

BASE = dt.datetime(2023, 1, 1, 12, 0, 0)
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

ETL_SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count int,"
    " trip_distance double, fare_amount double, tip_amount double, total_amount double, payment_type int"
)
DQ_SCHEMA = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count int,"
    " trip_distance double, fare_amount double, tip_amount double, total_amount double, tolls_amount double,"
    " extra double, mta_tax double"
)


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=2, memory="4g")
    yield session
    session.stop()


def at(hours=0, minutes=0.0):
    return BASE + dt.timedelta(hours=hours, minutes=minutes)


@pytest.fixture
def dq(spark):
    """Build a frame of the quality schema from (hour, minutes, passengers, distance, fare, tip, total, ...)."""

    def build(*rows):
        data = [(at(h), at(h, m) if m is not None else None, *rest) for h, m, *rest in rows]
        return spark.createDataFrame(data, DQ_SCHEMA)

    return build


@pytest.fixture
def five_trips(spark):
    rows = [(15, 1, 2.5, 12.5, 2.0), (20, 2, 5.0, 25.0, 5.0), (10, 1, 1.5, 8.5, 1.5), (30, 4, 8.0, 35.0, 7.0),
            (25, 2, 3.5, 15.0, 3.0)]
    data = [(1, at(i), at(i, m), p, d, f, t, f + t, 1) for i, (m, p, d, f, t) in enumerate(rows)]
    return spark.createDataFrame(data, ETL_SCHEMA)
