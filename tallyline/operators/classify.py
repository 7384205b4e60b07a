"""From raw deliveries to outcomes: decode, route, check, and tell duplicates apart.

`classify_rows` looks at one row at a time and runs unchanged on a stream. Which delivery of an
event id takes effect needs the other deliveries: `first_successes` and `resolve_duplicates`.

verdict (per row):      ok, error, invalid, unknown
outcome (per delivery): success, duplicate, error, invalid, unknown
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import events as E
from tallyline.functions.display import float_text
from tallyline.functions.parsing import clean_rating

# ---- fixed values: messages stored with failed events ----------------------------------

ERROR_TYPE = "EventProcessingError"
MALFORMED_TYPE = "JSONDecodeError"
MALFORMED_MESSAGE = "El mensaje no es un objeto JSON"
MISSING_MESSAGE = "Evento inválido: faltan campos requeridos: "
DURATION_MESSAGE = "duration_seconds debe ser positivo, recibido: "
RATING_MESSAGE = "Rating debe estar entre 1.0 y 10.0, recibido: "
NULL_MESSAGE = "Valor nulo o de tipo incorrecto en: "
WRAPPER = {
    S.CLICK: "Error procesando evento de click: ",
    S.VIEW: "Error procesando evento de visualización: ",
    S.RATING: "Error procesando evento de calificación: ",
}

# ----------------------------------------------------------------------------------------

def decode_rows(deliveries: DataFrame) -> DataFrame:
    """Each delivery with the fields of its event beside it. `readable` tells whether the text is one JSON object.

    Parsing, the test of the whole text, and the fields are three steps that each run once a row, see `E.once`.
    """
    place = ["event_data", "topic", "partition", "offset", "timestamp", "ord"]
    parsed = deliveries.select(
        F.col("value").alias("event_data"), "topic", "partition", "offset", "timestamp",
        E.arrival_order(F.col("partition"), F.col("offset")).alias("ord"), E.once(E.parsed_event(F.col("value"))).alias("_parsed"))
    tested = parsed.select(*place, E.once(F.when(E.readable(F.col("_parsed"), F.col("event_data")), F.col("_parsed")[0])).alias("_event"))
    fields = E.event_fields(F.col("_event"))
    return tested.select(*place, F.col("_event").isNotNull().alias("readable"), E.once(F.struct(
        *fields, _number(F.col("_event")["rating"]).alias("number"))).alias("_fields")).select(*place, "readable", "_fields.*")


def _number(text: Column) -> Column:
    """Ratings may be numeric text; unlike Spark's cast, `12d` or `1f` is none."""
    return F.when(~text.rlike("[dDfF]$"), text.try_cast("double"))


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def passes() -> Column:
    """Known type, every required value there and readable, ranges kept."""
    complete = (
        F.col("event_id").isNotNull() & F.col("anime_id").isNotNull()
        & F.col("user_id").isNotNull() & F.col("occurred_at").isNotNull()
    )
    own = (
        F.when(_is(S.CLICK), True)
        .when(_is(S.VIEW), F.col("duration_seconds") >= 0)
        .when(_is(S.RATING), F.col("number").between(S.MIN_RATING, S.MAX_RATING))
    )
    return complete & F.coalesce(own, F.lit(False))


def verdict() -> Column:
    """The keys of the JSON object are only looked at for rows that do not pass."""
    known = F.col("event_type").isin(*S.EVENT_TYPES)
    keys_gone = F.size(E.missing_keys(F.col("event_type"), F.col("event_data")))
    return (
        F.when(passes(), "ok")
        .when(~known, "unknown")
        .when(~F.col("readable"), "invalid")
        .when(F.col("event_type").isNull(), "unknown")
        .when(keys_gone > 0, "invalid")
        .otherwise("error")
    )


def _broken_rule() -> Column:
    """What the ledger says of a failed event: the range that is broken, else the unusable values."""
    out_of_range = F.when(
        _is(S.VIEW) & (F.col("duration_seconds") < 0),
        F.concat(F.lit(DURATION_MESSAGE), F.col("duration_seconds").cast("string")),
    ).when(
        _is(S.RATING) & ~F.col("number").between(S.MIN_RATING, S.MAX_RATING),
        F.concat(F.lit(RATING_MESSAGE), float_text(F.col("number"))),
    )
    unusable = F.concat_ws(
        "', '",
        *[F.when(F.col(k).isNull(), k) for k in ("event_id", "anime_id", "user_id", "occurred_at")],
        F.when(_is(S.VIEW) & F.col("duration_seconds").isNull(), "duration_seconds"),
        F.when(_is(S.RATING) & F.col("number").isNull(), "rating"),
    )
    return F.coalesce(out_of_range, F.concat(F.lit(NULL_MESSAGE + "['"), unusable, F.lit("']")))


def classify_rows(deliveries: DataFrame, now: Column | None = None) -> DataFrame:
    """Decode and check each delivery by itself; adds `verdict`, and `now` as the time of processing.

    Needs value, topic, partition, offset, timestamp. Row-local: no shuffle, streams as it is.
    """
    moment = F.lit(None) if now is None else now
    return decode_rows(deliveries).select(
        "*", moment.cast("timestamp_ntz").alias("processed_at"), E.once(verdict()).alias("verdict"))


def with_messages(rows: DataFrame) -> DataFrame:
    """Adds the messages stored with a failure."""
    malformed = F.col("event_type").isNull() | ~F.col("readable")
    prefix = F.lit(None).cast("string")
    for event_type, text in WRAPPER.items():
        prefix = F.when(_is(event_type), text).otherwise(prefix)
    error, invalid = F.col("verdict") == "error", F.col("verdict") == "invalid"
    keys = F.array_join(E.missing_keys(F.col("event_type"), F.col("event_data")), "', '")
    return (
        rows.withColumn("ledger_message", F.when(error, _broken_rule()))
        .withColumn("error_type", F.when(error, ERROR_TYPE).when(
            invalid, F.when(malformed, MALFORMED_TYPE).otherwise(ERROR_TYPE)))
        .withColumn("error_message", F.when(error, F.concat(prefix, F.col("ledger_message"))).when(
            invalid, F.when(malformed, MALFORMED_MESSAGE).otherwise(
                F.concat(F.lit(MISSING_MESSAGE + "['"), keys, F.lit("']")))))
        .withColumn("ledger_aggregate_id", E.ledger_aggregate_id())
    )


def succeeding(rows: DataFrame) -> DataFrame:
    """The rows that pass every check, as typed events; a missing aggregate id is derived."""
    return rows.where(F.col("verdict") == "ok").select(
        "event_id", "event_type", E.ledger_aggregate_id().alias("aggregate_id"), "anime_id", "user_id",
        F.when(_is(S.VIEW), F.col("duration_seconds")).alias("duration_seconds"),
        F.when(_is(S.RATING), clean_rating(F.col("number"))).alias("rating"),
        "occurred_at", "ord", "processed_at",
    )


def rejected(rows: DataFrame) -> DataFrame:
    """The rows that failed a check, as stored for the dead-letter table."""
    failed = rows.where(F.col("verdict").isin("invalid", "error"))
    return with_messages(failed).select(*S.REJECT.fieldNames())


def checked(rows: DataFrame) -> DataFrame:
    """Every delivery with all that later steps need, as one narrow table to store: the raw text stays
    only with failures."""
    failed = F.col("verdict").isin("invalid", "error")
    return with_messages(rows).select(
        *[c for c in S.CHECKED.fieldNames() if c not in ("event_data", "duration_seconds", "rating")],
        F.when(failed, F.col("event_data")).alias("event_data"),
        F.when(_is(S.VIEW), F.col("duration_seconds")).alias("duration_seconds"),
        F.when(_is(S.RATING) & (F.col("verdict") == "ok"), clean_rating(F.col("number"))).alias("rating"),
    )


def checked_successes(checked: DataFrame) -> DataFrame:
    """`succeeding` from a stored `checked` table."""
    return checked.where(F.col("verdict") == "ok").withColumn("aggregate_id", F.col("ledger_aggregate_id")).select(
        *S.SUCCESS.fieldNames())


def checked_rejects(checked: DataFrame) -> DataFrame:
    """`rejected` from a stored `checked` table."""
    return checked.where(F.col("verdict").isin("invalid", "error")).select(*S.REJECT.fieldNames())


def first_successes(rows: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """One row per event id: the first delivery that passes, unless the ledger has its success."""
    return first_of_each(succeeding(rows), ledger)


def first_of_each(passing: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Of the deliveries of one topic the first one of each event id, unless the ledger has its success.

    The place of the first is found by a hash aggregate over id and place, folded map-side. Only ids that came more than once are
    looked up again, in a plain left join: a small lookup is broadcast, else large partitions of a hot id are split. So no
    payload is sorted, and those of unique ids are not moved for it. The ledger is first cut down to the ids at hand.
    """
    per_id = passing.groupBy(F.col("event_id").alias("_id")).agg(F.min("ord").alias("_first"), F.count("*").alias("_n"))
    lookup = per_id.where(F.col("_n") > 1).select("_id", "_first")
    first = passing.join(lookup, F.col("event_id") == F.col("_id"), "left").where(
        F.col("_first").isNull() | (F.col("ord") == F.col("_first"))).select(*passing.columns)
    if ledger is not None:
        known = processed_ids(ledger).join(passing.select("event_id").distinct(), "event_id", "left_semi")
        first = first.join(known, "event_id", "left_anti")
    return first


def processed_ids(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == "success").select("event_id")


def drop_processed(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Deliveries whose event id has no success in the ledger; ids that only failed may come again."""
    return rows.join(processed_ids(ledger), "event_id", "left_anti")


def resolve_duplicates(rows: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Adds `outcome` to every delivery.

    The first passing delivery of an id is the success, whatever comes after it is a duplicate,
    failures before it are errors. The first success is found by a hash aggregate; only ids delivered
    more than once have to be looked up again. Copies of one id, and deliveries without an id, may make up a
    large part of the rows: the join is a plain left join, whose large partitions the planner splits at run time.
    """
    reached = F.col("verdict").isin("ok", "error")
    keyed = rows.withColumn("_id", F.when(reached, F.col("event_id")))
    per_id = keyed.where(F.col("_id").isNotNull()).groupBy("_id").agg(
        F.min(F.when(F.col("verdict") == "ok", F.col("ord"))).alias("_first"), F.count("*").alias("n"))
    repeated = F.col("n") > 1
    if ledger is not None:
        done = processed_ids(ledger).select(F.col("event_id").alias("_id"), F.lit(True).alias("_done"))
        per_id = per_id.join(done, "_id", "left").withColumn("_first", F.when(F.col("_done"), -1).otherwise(F.col("_first")))
        repeated = repeated | F.col("_done")
    lookup = per_id.where(repeated).select("_id", "_first")
    joined = keyed.join(lookup, "_id", "left")
    outcome = (
        F.when(~reached, F.col("verdict"))
        .when(F.col("ord") == F.col("_first"), "success")
        .when(F.col("ord") > F.col("_first"), "duplicate")
        .when((F.col("verdict") == "ok") & F.col("_first").isNull(), "success")
        .otherwise("error")
    )
    return joined.withColumn("outcome", outcome).drop("_id", "_first")


def classify_events(deliveries: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    return resolve_duplicates(classify_rows(deliveries), ledger)


ATTEMPT = ["event_id", "event_type", "ledger_aggregate_id", "ord", "ok", "ledger_message", "processed_at"]


def attempts(rows: DataFrame) -> DataFrame:
    """The deliveries that reached the range checks and name their event, passed or not."""
    return checked_attempts(with_messages(rows))


def checked_attempts(checked: DataFrame) -> DataFrame:
    """The same from a stored `checked` table."""
    reached = checked.where(F.col("verdict").isin("ok", "error") & F.col("event_id").isNotNull())
    return reached.withColumn("ok", F.col("verdict") == "ok").select(*ATTEMPT)


def stored_attempts(successes: DataFrame, rejects: DataFrame) -> DataFrame:
    """The same from stored tables of successes and rejects."""
    ok = successes.withColumn("ok", F.lit(True)).withColumnRenamed("aggregate_id", "ledger_aggregate_id")
    failed = rejects.where((F.col("verdict") == "error") & F.col("event_id").isNotNull()).withColumn("ok", F.lit(False))
    return (
        ok.withColumn("ledger_message", F.lit(None).cast("string")).select(*ATTEMPT)
        .unionByName(failed.select(*ATTEMPT))
    )


def failure_counts(attempts: DataFrame) -> DataFrame:
    """Per id: how many failures, and the place of its first success (`since`), if any."""
    return attempts.groupBy("event_id").agg(
        F.min(F.when(F.col("ok"), F.col("ord"))).alias("since"),
        F.count(F.when(~F.col("ok"), F.lit(1))).alias("n"),
    ).where(F.col("n") > 0)


def outstanding_failures(rejects: DataFrame, attempts: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Rejected deliveries that stay failures: not those that came after a success of their id.

    Only ids that both failed and succeeded are looked up. They are found by a hash aggregate over
    two narrow columns.
    """
    per_id = failure_counts(attempts).withColumnRenamed("event_id", "_id")
    if ledger is not None:
        failing = rejects.where(F.col("verdict") == "error").select("event_id").distinct()
        before = processed_ids(ledger).join(failing, "event_id", "left_semi").select(
            F.col("event_id").alias("_id"), F.lit(True).alias("_done"))
        per_id = per_id.join(before, "_id", "left").withColumn("since", F.when(F.col("_done"), -1).otherwise(F.col("since")))
    settled = per_id.where(F.col("since").isNotNull()).select("_id", "since")
    joined = rejects.withColumn("_id", F.when(F.col("verdict") == "error", F.col("event_id"))).join(settled, "_id", "left")
    return joined.where(F.col("since").isNull() | (F.col("ord") < F.col("since"))).drop("_id", "since")
