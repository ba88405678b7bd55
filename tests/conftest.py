from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tripflow.sources import schemas as S  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tripflow.session import local_session
    ckpt = str(tmp_path_factory.mktemp("checkpoints"))
    s = local_session(app="tripflow-tests", cores="*", shuffle_partitions=8, checkpoint=ckpt)
    yield s
    s.stop()


def _ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


# A valid raw row per feed; tests override single fields.
VALID = {
    "yellow": dict(VendorID=1, tpep_pickup_datetime=_ts("2024-01-01 10:00:00"),
                   tpep_dropoff_datetime=_ts("2024-01-01 10:20:00"), passenger_count=1.0,
                   trip_distance=2.0, RatecodeID=1, PULocationID=1, DOLocationID=2, payment_type=1,
                   fare_amount=10.0, extra=0.5, mta_tax=0.5, tip_amount=2.0, tolls_amount=0.0,
                   improvement_surcharge=1.0, total_amount=14.0, congestion_surcharge=0.0,
                   Airport_fee=0.0, store_and_fwd_flag="N"),
    "green": dict(VendorID=2, lpep_pickup_datetime=_ts("2024-01-01 11:00:00"),
                  lpep_dropoff_datetime=_ts("2024-01-01 11:10:00"), passenger_count=1.0,
                  trip_distance=1.5, RatecodeID=1, PULocationID=3, DOLocationID=4, payment_type=2,
                  fare_amount=8.0, extra=0.0, mta_tax=0.5, tip_amount=0.0, tolls_amount=0.0,
                  ehail_fee=None, improvement_surcharge=1.0, total_amount=9.5, trip_type=1,
                  congestion_surcharge=0.0, store_and_fwd_flag="N"),
    "hvfhv": dict(hvfhs_license_num="HV0003", dispatching_base_num="B01", originating_base_num="B01",
                  request_datetime=_ts("2024-01-01 09:55:00"), on_scene_datetime=_ts("2024-01-01 09:58:00"),
                  pickup_datetime=_ts("2024-01-01 10:00:00"), dropoff_datetime=_ts("2024-01-01 10:30:00"),
                  PULocationID=5, DOLocationID=6, trip_miles=4.0, trip_time=1800,
                  base_passenger_fare=20.0, tolls=0.0, bcf=0.5, sales_tax=1.5,
                  congestion_surcharge=2.75, airport_fee=0.0, tips=3.0, driver_pay=15.0,
                  shared_request_flag="N", shared_match_flag="N", access_a_ride_flag=" ",
                  wav_request_flag="N", wav_match_flag="N"),
}


def raw(spark, feed: str, *overrides: dict):
    """A raw feed DataFrame: one valid row per override dict, with fields replaced."""
    schema = S.RAW_SCHEMAS[feed]
    rows = []
    for o in overrides:
        r = dict(VALID[feed])
        r.update(o)
        rows.append(tuple(r[f.name] for f in schema.fields))
    return spark.createDataFrame(rows, schema)


def empty(spark, feed: str):
    return spark.createDataFrame([], S.RAW_SCHEMAS[feed])


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``df.explain(mode)`` prints it."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def plan_nodes(df, name: str) -> int:
    """Number of physical operators called ``name`` in the formatted plan."""
    import re
    return len(re.findall(rf"^\(\d+\) {re.escape(name)}\b", plan_text(df), flags=re.M))
