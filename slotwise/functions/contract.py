"""The beacon contract: fixed vocabularies, column lists and Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source system's contract) -------------------
MICROS_PER_UNIT = 1_000_000
EVENT_TYPES = ("ad_request", "ad_impression", "ad_click", "ad_quartile", "ad_error")
BREAK_TYPES = ("preroll", "midroll", "postroll")
PLATFORMS = ("android", "ios", "web", "tv")
MARKETS = ("IN", "US", "GB", "AE")
QUARTILES = (25, 50, 75, 100)
REQUIRED = (
    "event_id",
    "event_type",
    "event_ts",
    "session_id",
    "content_id",
    "pod_id",
    "break_type",
    "platform",
    "market",
    "campaign_id",
)
EVENT_ID_MIN_LENGTH = 8
MARKET_LENGTH = 2
# quality gate thresholds
GATE_MIN_ROWS = 50
GATE_MAX_IMPRESSION_RATIO = 1.15
GATE_FILL_BAND = (0.2, 0.99)
GATE_SOFT_FILL_BAND = (0.55, 0.95)
# documented lateness allowance
LATE_WINDOW_HOURS = 36

# Every key of the JSON object, in contract order, with its JSON type.
FIELDS = (
    ("event_id", "string"),
    ("event_type", "string"),
    ("event_ts", "string"),
    ("ingest_ts", "string"),
    ("session_id", "string"),
    ("content_id", "string"),
    ("pod_id", "string"),
    ("slot_index", "integer"),
    ("break_type", "string"),
    ("platform", "string"),
    ("market", "string"),
    ("campaign_id", "string"),
    ("creative_id", "string?"),
    ("advertiser_id", "string?"),
    ("quartile", "integer?"),
    ("error_code", "string?"),
    ("bid_floor_micros", "integer?"),
    ("clearing_price_micros", "integer?"),
    ("is_late", "boolean"),
)
ALLOWED_KEYS = tuple(name for name, _ in FIELDS)

# Typed beacon (bronze after parsing, before silver defaults).
BEACON_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("content_id", T.StringType()),
        T.StructField("pod_id", T.StringType()),
        T.StructField("slot_index", T.IntegerType()),
        T.StructField("break_type", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("creative_id", T.StringType()),
        T.StructField("advertiser_id", T.StringType()),
        T.StructField("quartile", T.IntegerType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("bid_floor_micros", T.LongType()),
        T.StructField("clearing_price_micros", T.LongType()),
        T.StructField("is_late", T.BooleanType()),
    ]
)

# Bronze JSON read with an explicit schema: timestamps stay text so that a bad
# one is a silver error (as in the contract), never a silent null.
BRONZE_TEXT_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType()) if f.name in ("event_ts", "ingest_ts") else f
        for f in BEACON_SCHEMA.fields
    ]
)

SILVER_COLUMNS = (
    "event_id",
    "event_type",
    "event_ts",
    "ingest_ts",
    "event_date",
    "session_id",
    "content_id",
    "pod_id",
    "slot_index",
    "break_type",
    "platform",
    "market",
    "campaign_id",
    "creative_id",
    "advertiser_id",
    "quartile",
    "error_code",
    "bid_floor_micros",
    "clearing_price_micros",
    "is_late",
)

CAMPAIGN_KEYS = ("event_date", "campaign_id", "market", "platform", "break_type")
POD_KEYS = ("event_date", "pod_id", "break_type", "content_id", "platform", "market")
# --- end of fixed values -------------------------------------------------------
