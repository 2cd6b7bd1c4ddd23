"""Contracts: the schemas of streams and tables, stated once and checked before every write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)  # type: ignore[return-value]


#: Player telemetry. event_ts and ingest_ts are epoch milliseconds on the wire and timestamps after decoding.
PLAYBACK_WIRE = (
    "event_id string, session_id string, profile_id bigint, title_id bigint, region_code string, event_type string, event_ts bigint, ingest_ts bigint,"
    " position_seconds int, device_type string, app_version string, cdn_pop string, bitrate_kbps int, rebuffer_ms int, startup_ms int, error_code string, ab_bucket string"
)
PLAYBACK_EVENTS = PLAYBACK_WIRE.replace("event_ts bigint", "event_ts timestamp").replace("ingest_ts bigint", "ingest_ts timestamp")
CHANGE = "__op string, __lsn bigint, __source_ts timestamp, __deleted string"
TABLES = {
    "playback_events": PLAYBACK_EVENTS,
    "regions": f"region_id smallint, region_code string, display_name string, cdn_provider string, {CHANGE}",
    "genres": f"genre_id smallint, genre_name string, {CHANGE}",
    "subscribers": f"subscriber_id bigint, created_at timestamp, updated_at timestamp, {CHANGE}",
    "subscriptions": f"subscription_id bigint, subscriber_id bigint, tier string, status string, monthly_price double, started_at timestamp, ended_at timestamp, created_at timestamp, updated_at timestamp, {CHANGE}",
    "profiles": f"profile_id bigint, subscriber_id bigint, display_name string, is_kids boolean, created_at timestamp, updated_at timestamp, {CHANGE}",
    "titles": f"title_id bigint, external_ref string, title_name string, content_type string, runtime_seconds int, release_date date, maturity_rating string, is_original boolean, licence_expires date, created_at timestamp, updated_at timestamp, {CHANGE}",
    "title_genres": f"title_id bigint, genre_id smallint, {CHANGE}",
    "title_availability": f"title_id bigint, region_id smallint, available_from timestamp, available_to timestamp, {CHANGE}",
    "title_costs": "title_id bigint, licence_cost_usd decimal(14,2), production_cost_usd decimal(14,2), licence_start date, licence_end date, cost_type string",
    "online_feature_audit": "session_id string, profile_id bigint, seconds_watched int, rebuffer_seconds double, completion_ratio double, snapshot_date date",
    "qoe_windows": "pop string, region_code string, window_end timestamp, sessions bigint, rebuffer_events bigint, rebuffer_seconds double, playback_seconds double, error_events bigint, p95_startup_ms int, rebuffer_ratio double",
    "qoe_alerts": "alert_type string, severity string, cdn_pop string, region_code string, detected_at timestamp, rebuffer_ratio double, baseline_ratio double, z_score double, sessions_affected bigint, p95_startup_ms int, error_rate double, runbook string",
}

# Sets, thresholds and windows of the data model.
EVENT_TYPES = ["START", "HEARTBEAT", "PAUSE", "RESUME", "SEEK", "BITRATE_CHANGE", "REBUFFER", "ERROR", "COMPLETE", "ABANDON"]
TIERS = ["basic", "standard", "premium"]
SEGMENTS = ["dormant", "occasional", "regular", "daily"]
HEARTBEAT_SECONDS = 10
REBUFFER_CAP_MS = 60_000
MIN_VALID_SESSION_SECONDS = 30
COMPLETION_THRESHOLD = 0.90
LOOKBACK_DAYS = 3
SESSION_GAP = "30 minutes"
FEATURE_WINDOWS = (7, 30, 90)
MAX_PER_GENRE = 3
EMBEDDING_DIM = 128


def contract_errors(df: DataFrame, expected: T.StructType | str, not_null: tuple[str, ...] = ()) -> list[str]:
    """How the table departs from its contract: names, types, and nullability of the named columns."""
    want = schema(expected) if isinstance(expected, str) else expected
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    out = [f"missing: {f.name}" for f in want if f.name not in have]
    out += [f"{f.name}: {have[f.name]}, not {f.dataType.simpleString()}" for f in want if f.name in have and have[f.name] != f.dataType.simpleString()]
    out += [f"unexpected: {n}" for n in have if n not in set(want.names)]
    return out + [f"not in the table, so it cannot be checked: {c}" for c in not_null if c not in have]


def check_contract(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """The table itself if it keeps its contract; otherwise an error before anything is written."""
    if errors := contract_errors(df, expected):
        raise ValueError("; ".join(errors))
    return df
