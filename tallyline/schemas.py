"""Explicit schemas of every table; nothing in the package infers a schema."""

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "RATING": T.DecimalType(4, 2),
}


def table_schema(columns: str) -> T.StructType:
    """Schema of `name TYPE, …`; needs no session, unlike a DDL string."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# ---- fixed values: event types, required keys, statuses --------------------------------

CLICK = "ClickRegistered"
VIEW = "ViewRegistered"
RATING = "RatingGiven"
EVENT_TYPES = (CLICK, VIEW, RATING)

REQUIRED_KEYS = {
    CLICK: ("anime_id", "user_id", "occurred_at", "event_id"),
    VIEW: ("anime_id", "user_id", "duration_seconds", "occurred_at", "event_id"),
    RATING: ("anime_id", "user_id", "rating", "occurred_at", "event_id"),
}

DLQ_STATUSES = ("failed", "retrying", "resolved", "archived")
TOPIC = "anime-events"

MIN_RATING, MAX_RATING = 1.0, 10.0
MAX_REPORT_ROWS = 100
MIN_RATERS = 5

# ----------------------------------------------------------------------------------------

COMMAND = table_schema(
    "command_id STRING, command_type STRING, anime_id INT, user_id STRING,"
    " duration_seconds INT, rating DOUBLE, issued_at TIMESTAMP_NTZ"
)

DELIVERY = table_schema(
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ"
)

# JSON payload of a delivery. `rating` stays text: it may arrive as a number or as a numeric string.
EVENT_JSON = table_schema(
    "event_id STRING, event_type STRING, aggregate_id STRING, anime_id INT, user_id STRING,"
    " duration_seconds INT, rating STRING, occurred_at TIMESTAMP_NTZ"
)

EVENT_LOG = table_schema(
    "event_id STRING, event_type STRING, aggregate_id STRING, event_data STRING,"
    " occurred_at TIMESTAMP_NTZ, version INT, metadata STRING, created_at TIMESTAMP_NTZ, event_date DATE"
)

# One event per id that took effect.
SUCCESS = table_schema(
    "event_id STRING, event_type STRING, aggregate_id STRING, anime_id INT, user_id STRING,"
    " duration_seconds INT, rating RATING, occurred_at TIMESTAMP_NTZ, ord BIGINT, processed_at TIMESTAMP_NTZ"
)

# Per (item, user): clicks, views and the current rating side by side, each with the arrival
# order of its latest event, so two activity tables merge associatively.
ACTIVITY = table_schema(
    "anime_id INT, user_id STRING,"
    " click_count BIGINT, last_click_at TIMESTAMP_NTZ, click_ord BIGINT,"
    " view_count BIGINT, total_duration_seconds BIGINT, last_view_at TIMESTAMP_NTZ, view_ord BIGINT,"
    " rating RATING, rated_at TIMESTAMP_NTZ, rating_ord BIGINT, updated_at TIMESTAMP_NTZ"
)

ITEM_STATS = table_schema(
    "anime_id INT, total_clicks BIGINT, total_views BIGINT, total_ratings BIGINT,"
    " average_rating DOUBLE, total_duration_seconds BIGINT, updated_at TIMESTAMP_NTZ"
)

# What item statistics are made of; all sums, so changes can be added up.
ITEM_TOTALS = table_schema(
    "anime_id INT, total_clicks BIGINT, total_views BIGINT, total_ratings BIGINT, rating_cents BIGINT,"
    " total_duration_seconds BIGINT, updated_at TIMESTAMP_NTZ"
)

# Items of the stored top lists; a row without an item says that the list is there.
LEADERS = table_schema(
    "list STRING, anime_id INT, total_clicks BIGINT, total_views BIGINT, total_ratings BIGINT, average_rating DOUBLE,"
    " total_duration_seconds BIGINT"
)

LEDGER = table_schema(
    "event_id STRING, event_type STRING, aggregate_id STRING, status STRING, error_message STRING,"
    " processed_at TIMESTAMP_NTZ"
)

# Deliveries that failed the stateless checks, before duplicates are known.
REJECT = table_schema(
    "event_id STRING, event_type STRING, aggregate_id STRING, event_data STRING, verdict STRING,"
    " error_type STRING, error_message STRING, ledger_message STRING, ledger_aggregate_id STRING,"
    " topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ, ord BIGINT,"
    " processed_at TIMESTAMP_NTZ"
)

# All deliveries after the row checks, as the batch plan stores them, by verdict.
CHECKED = table_schema(
    "event_id STRING, event_type STRING, aggregate_id STRING, anime_id INT, user_id STRING,"
    " duration_seconds INT, rating RATING, occurred_at TIMESTAMP_NTZ, ord BIGINT, event_data STRING,"
    " error_type STRING, error_message STRING, ledger_message STRING, ledger_aggregate_id STRING,"
    " topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ,"
    " processed_at TIMESTAMP_NTZ, verdict STRING"
)

# What a stream remembers of an event id that took effect: two hashes and the place of the success.
SUCCEEDED_ID = table_schema("h1 BIGINT, h2 BIGINT, ord BIGINT")
KNOWN_ID = table_schema("event_id STRING")

COUNTER = table_schema("event_type STRING, outcome STRING, deliveries BIGINT")

# What was done to a dead letter: 'retry' or 'resolve'.
MARK = table_schema("dlq_id STRING, mark STRING, marked_at TIMESTAMP_NTZ, notes STRING")

DEAD_LETTER = table_schema(
    "dlq_id STRING, event_id STRING, event_type STRING, aggregate_id STRING, event_data STRING,"
    " error_type STRING, error_message STRING, kafka_topic STRING, kafka_partition INT,"
    " kafka_offset BIGINT, failed_at TIMESTAMP_NTZ, retry_count INT, last_retry_at TIMESTAMP_NTZ,"
    " status STRING, resolved_at TIMESTAMP_NTZ, notes STRING"
)

CATALOG = table_schema(
    "myanimelist_id INT, title STRING, description STRING, image STRING, type STRING, episodes INT,"
    " status STRING, premiered STRING, released_season STRING, released_year DOUBLE, source STRING,"
    " genres STRING, themes STRING, studios STRING, producers STRING, demographic STRING,"
    " duration STRING, rating STRING, score DOUBLE, ranked INT, popularity INT, members INT,"
    " favorites INT, characters STRING, source_url STRING"
)
