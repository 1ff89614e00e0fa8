from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from slotwise.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="slotwise-tests")
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    """An ISO-8601 text (with offset) as a naive UTC datetime (session time zone is UTC)."""
    v = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    if v.tzinfo is not None:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


# What a row is unless a test says otherwise: an ad request, late in the morning of 18 May 2031.
BASE = dict.fromkeys(
    ("ingest_ts", "creative_id", "advertiser_id", "quartile", "error_code", "bid_floor_micros", "clearing_price_micros")
) | {
    "event_type": "ad_request",
    "event_ts": "2031-05-18T10:00:00+00:00",
    "session_id": "s1",
    "content_id": "film-7",
    "pod_id": "break-2",
    "slot_index": 0,
    "break_type": "postroll",
    "platform": "web",
    "market": "GB",
    "campaign_id": "spring",
    "is_late": False,
}


def beacons_df(spark, rows: list[dict], dt_value: str = "2031-05-18"):
    """Typed beacon rows (BEACON_SCHEMA + dt) from partial dicts over BASE."""
    from pyspark.sql import types as T

    from slotwise.functions.contract import BEACON_SCHEMA

    schema = T.StructType([*BEACON_SCHEMA.fields, T.StructField("dt", T.DateType())])
    out = []
    for i, r in enumerate(rows):
        full = {**BASE, "event_id": f"evt-{i:08d}", **r}
        for k in ("event_ts", "ingest_ts"):
            if isinstance(full[k], str):
                full[k] = ts(full[k])
        d = full.pop("dt", dt_value)
        full["dt"] = dt.date.fromisoformat(d) if isinstance(d, str) else d
        out.append(tuple(full[f.name] for f in schema.fields))
    return spark.createDataFrame(out, schema)
