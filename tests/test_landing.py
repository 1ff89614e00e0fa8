"""Landing: the contract rules on hand-made lines, the landed table, re-landing."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from slotwise.operators import landing
from slotwise.session import scratch_path

VALID = {
    "event_id": "beacon-0007",
    "event_type": "ad_request",
    "event_ts": "2025-03-04T08:15:00+00:00",
    "ingest_ts": "2025-03-04T08:15:02+00:00",
    "session_id": "sess_31",
    "content_id": "cnt_12",
    "pod_id": "pod_77",
    "slot_index": 2,
    "break_type": "postroll",
    "platform": "tv",
    "market": "GB",
    "campaign_id": "cmp_5",
    "creative_id": None,
    "advertiser_id": None,
    "quartile": None,
    "error_code": None,
    "bid_floor_micros": 91000,
    "clearing_price_micros": None,
    "is_late": False,
}


def line(**changes) -> str:
    obj = dict(VALID)
    for k, v in changes.items():
        if v is DROP:
            obj.pop(k)
        else:
            obj[k] = v
    return json.dumps(obj, separators=(",", ":"))


DROP = object()
TEXT = json.dumps(VALID, separators=(",", ":"))

CASES = [
    (TEXT[:-1], "V1"),
    ("[1,2]", "V2"),
    ("5", "V2"),
    (line(event_type="ad_unknown"), "V8"),
    (line(campaign_id=DROP), "V3"),
    (line(zz=1), "V4"),
    (line(slot_index="1"), "V6"),
    (line(slot_index=True), "V6"),
    (line(slot_index=1.5), "V6"),
    (line(slot_index=None), "V6"),
    (line(slot_index=-1), "V14"),
    (line(event_id="short"), "V12"),
    (line(event_id=12345678), "V5"),
    (line(campaign_id=None), "V5"),
    (line(ingest_ts=None), "V5"),
    (line(creative_id={"a": 1}), "V5"),
    (line(market="IND"), "V13"),
    (line(quartile=30), "V11"),
    (line(bid_floor_micros=-5), "V15"),
    (TEXT.replace('"bid_floor_micros":91000', '"bid_floor_micros":1' + "0" * 30), "V6"),
    (TEXT.replace('"bid_floor_micros":91000', '"bid_floor_micros":9007199254740993.5'), "V6"),
    (TEXT.replace('"bid_floor_micros":91000', '"bid_floor_micros":9007199254740993.0'), None),
    (line(slot_index=3_000_000_000), "V6"),
    (line(is_late="true"), "V7"),
    (line(is_late=None), "V7"),
    (line(break_type="bumper"), "V9"),
    (line(platform="roku"), "V10"),
    (TEXT[:-1] + ',"market":"US"}', "V1"),
    (TEXT.replace('"slot_index":2', '"slot_index":2.0'), None),
    (line(quartile=25.0), None),
    (line(quartile=100), None),
    (line(ingest_ts=DROP), None),
    (line(is_late=DROP), None),
    (line(event_ts="garbage"), None),
    (line(error_code="TIMEOUT"), None),
    (line(slot_index=DROP), None),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(i, text) for i, (text, _) in enumerate(CASES)] + [(len(CASES), "   ")]
    df = spark.createDataFrame(rows, "i int, value string")
    stamp = dt.datetime(2031, 5, 18, 12, 0, tzinfo=dt.timezone.utc)
    return {r["i"]: r for r in landing.classify(df, landed_at=stamp).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rule(classified, i):
    text, rule = CASES[i]
    r = classified[i]
    if rule is None:
        assert r["status"] == "ok", (text, r["errors"])
        assert r["errors"] == []
    else:
        assert r["status"] == "bad"
        assert r["errors"] == [rule], text


def test_blank_line_is_in_neither_class(classified):
    assert len(CASES) not in classified


def test_missing_ingest_is_stamped_and_fields_are_typed(classified):
    i = next(k for k, (t, _) in enumerate(CASES) if '"ingest_ts"' not in t and t.startswith("{"))
    assert classified[i]["ingest_ts"].startswith("2031-05-18T12:00:00")
    ok = classified[next(k for k, (t, _) in enumerate(CASES) if '"slot_index":2.0' in t)]
    assert ok["slot_index"] == 2 and ok["bid_floor_micros"] == 91000 and ok["is_late"] is False


def test_strict_timestamps_rejects_garbage(spark):
    df = spark.createDataFrame([(line(event_ts="garbage"),), (TEXT,)], "value string")
    out = [r["errors"] for r in landing.classify(df, strict_timestamps=True).collect()]
    assert sorted(out) == [[], ["V16"]]


def test_relanding_a_corrected_drop_clears_its_quarantine(spark):
    root = scratch_path(spark, "landing-test")
    path = f"{root}/landed"

    def land(values, src):
        df = spark.createDataFrame([(v,) for v in values], "value string").select(
            "value", F.lit("2031-05-18").cast("date").alias("dt"), F.lit(src).alias("src")
        )
        return landing.land(df, path)

    assert land([TEXT, "[1,2]"], "a") == (1, 1)
    assert land([TEXT], "b") == (1, 0)
    assert land([TEXT, TEXT], "a") == (2, 0)  # corrected drop `a`: its bad row must go
    landed = spark.read.parquet(path)
    assert landing.quarantine(landed).count() == 0
    assert landing.bronze(landed).count() == 3  # drop b survives


def test_read_drop_keeps_file_stem(spark):
    root = scratch_path(spark, "drops")
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/evening-batch.jsonl", "w") as f:
        f.write(TEXT + "\n\n  " + TEXT + "  \n")
    lines = landing.read_drop(spark, root, dt="2031-05-18")
    out = landing.classify(lines).select("src", "status").collect()
    assert [(r["src"], r["status"]) for r in out] == [("evening-batch", "ok")] * 2
