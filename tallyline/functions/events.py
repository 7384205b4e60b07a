"""Event envelope: ids, JSON encoding and decoding, required keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline import schemas as S

PARTITION_BITS = 20
# Keeps microseconds; the default pattern would cut them to milliseconds.
PARSED = ("event_id: variant, event_type: string, aggregate_id: string, anime_id: int, user_id: variant,"
          " duration_seconds: int, rating: string, occurred_at: string")
ISO_ZONE = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"
ISO_TIME = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
JSON_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def aggregate_id(item: Column) -> Column:
    return F.concat(F.lit("anime_"), item.cast("string"))


def ledger_aggregate_id() -> Column:
    """The aggregate id as sent, or the one that follows from the item."""
    return F.coalesce("aggregate_id", aggregate_id(F.col("anime_id")))


def command_event_id(command_id: Column) -> Column:
    """Deterministic, so a recomputed task or a resent command gives the same event."""
    return F.sha2(command_id, 256)


def encode_event() -> Column:
    """The event as one JSON object; fields another event type does not have are left out."""
    return F.to_json(
        F.struct(
            "event_id", "event_type", "aggregate_id", "occurred_at", "version",
            F.from_json("metadata", "map<string,string>").alias("metadata"),
            "anime_id", "user_id", "duration_seconds", "rating", "timestamp",
        ),
        JSON_TIME,
    )


def parsed_event(value: Column) -> Column:
    """The event and an end mark, in one parse.

    The parser stops after the first value of a text. The text is therefore read as the first element of a list whose
    second one carries the hash of the text: whatever follows the object, or is missing from it, spoils the list.
    """
    whole = F.concat(F.lit("["), value, F.lit(',{"end_mark":'), F.xxhash64(value).cast("string"), F.lit("}]"))
    return F.from_json(whole, f"array<struct<{PARSED}, end_mark: bigint>>", {"allowSingleQuotes": "false"})


def readable(parsed: Column, value: Column) -> Column:
    """Whether the text was exactly one JSON object."""
    one = (F.size(parsed) == 2) & (F.try_element_at(parsed, F.lit(2))["end_mark"] == F.xxhash64(value))
    return F.coalesce(one & parsed[0].isNotNull() & F.ltrim(value).startswith("{"), F.lit(False))


def _text(value: Column) -> Column:
    """A JSON string; other values are no text."""
    return F.when(F.schema_of_variant(value) == "STRING", F.variant_get(value, "$", "string"))


def event_time(text: Column) -> Column:
    """An ISO date or time; one with a zone is converted to UTC."""
    moment = F.when(text.rlike(ISO_TIME), text)
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(moment.rlike(ISO_ZONE), utc).otherwise(moment.try_cast("timestamp_ntz"))


def event_fields(event: Column) -> list[Column]:
    """The fields of a parsed event, by EVENT_JSON. Ids that are no JSON strings are NULL."""
    own = {"event_id": _text, "user_id": _text, "occurred_at": event_time}
    return [own.get(f.name, lambda c: c)(event[f.name]).alias(f.name) for f in S.EVENT_JSON.fields]


def once(value: Column) -> Column:
    """A generator of the one row that it stands in. What it holds is worked out once, whatever uses it: neither a filter
    nor a later step moves the expression to where it would run again."""
    return F.explode(F.array(value))


def missing_keys(event_type: Column, value: Column) -> Column:
    """Required keys absent from the JSON object, in their fixed order. A present null is not missing;
    NULL when the text is no JSON object or the type is unknown."""
    required = F.lit(None).cast("array<string>")
    for name, keys in S.REQUIRED_KEYS.items():
        required = F.when(event_type == name, F.array(*map(F.lit, keys))).otherwise(required)
    return F.array_except(required, F.json_object_keys(value))


def arrival_order(partition: Column, offset: Column) -> Column:
    """Offset, then partition, in one long: unique in a topic, and fixed width, so that
    `max_by(x, ord)` runs as a hash aggregate. Fails beyond 2^20 partitions or 2^42 offsets rather than
    putting a delivery in a wrong place."""
    place, part = offset.cast("long"), partition.cast("long")
    fits = place.between(0, (1 << 42) - 1) & part.between(0, (1 << PARTITION_BITS) - 1)
    ord_ = F.shiftleft(place, PARTITION_BITS) + part
    beyond = F.raise_error(F.lit("offset or partition beyond the arrival order")).cast("long")
    return F.when(fits, ord_).when(~fits, beyond)
