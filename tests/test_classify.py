import json
from datetime import datetime

import pytest

from helpers import click, deliveries, event, rating, records, replay, view
from tallyline import schemas as S
from tallyline.operators import classify as C
from tallyline.plans.project import project


def outcomes(spark, *bodies, **options):
    out = C.classify_events(deliveries(spark, *bodies), **options)
    return [r[0] for r in out.orderBy("offset").select("outcome").collect()]


def failure(spark, body):
    row = C.rejected(C.classify_rows(deliveries(spark, body))).first()
    return row and (row.verdict, row.error_type, row.error_message)


@pytest.mark.parametrize("body", [click(), view(), rating(), view(aggregate_id="absent"), rating(rating="8.5"),
                                  rating(rating=10.0), rating(rating=1), view(duration_seconds=0)])
def test_passing_events(spark, body):
    assert outcomes(spark, body) == ["success"]


@pytest.mark.parametrize("body, message", [
    (view(duration_seconds=-10),
     "Error procesando evento de visualización: duration_seconds debe ser positivo, recibido: -10"),
    (rating(rating=11.0), "Error procesando evento de calificación: Rating debe estar entre 1.0 y 10.0, recibido: 11.0"),
    (rating(rating=1e7), "Error procesando evento de calificación: Rating debe estar entre 1.0 y 10.0, recibido: 10000000.0"),
    (rating(rating=0.00005), "Error procesando evento de calificación: Rating debe estar entre 1.0 y 10.0, recibido: 5e-05"),
    (click(user_id=None), "Error procesando evento de click: Valor nulo o de tipo incorrecto en: ['user_id']"),
    (click(anime_id="7"), "Error procesando evento de click: Valor nulo o de tipo incorrecto en: ['anime_id']"),
    (view(duration_seconds=3.5),
     "Error procesando evento de visualización: Valor nulo o de tipo incorrecto en: ['duration_seconds']"),
    (rating(rating="12d"), "Error procesando evento de calificación: Valor nulo o de tipo incorrecto en: ['rating']"),
])
def test_errors(spark, body, message):
    assert failure(spark, body) == ("error", "EventProcessingError", message)


def test_missing_keys_are_named_in_order(spark):
    body = {"event_type": "ViewRegistered", "anime_id": 1}
    assert failure(spark, body) == (
        "invalid", "EventProcessingError",
        "Evento inválido: faltan campos requeridos: ['user_id', 'duration_seconds', 'occurred_at', 'event_id']")


def test_missing_key_wins_over_range(spark):
    assert failure(spark, view(duration_seconds=-1, user_id="absent"))[0] == "invalid"


@pytest.mark.parametrize("text", ["nope", "[1, 2]", '{"event_type": "ClickRegistered"', None, "5", ""])
def test_malformed_text_is_a_dead_letter(spark, text):
    assert failure(spark, text)[:2] == ("invalid", "JSONDecodeError")
    letter = project(deliveries(spark, text), datetime(2024, 1, 1)).dead_letters.first()
    assert (letter.event_id, letter.event_type, letter.event_data) == ("unknown", "unknown", text)
    assert letter.failed_at == datetime(2024, 1, 1)


def test_unknown_types_are_skipped(spark):
    assert outcomes(spark, event("UnknownEvent"), {}, {"event_id": "x"}) == ["unknown"] * 3
    assert C.rejected(C.classify_rows(deliveries(spark, event("UnknownEvent")))).count() == 0


def test_duplicates_follow_arrival(spark):
    assert outcomes(spark, click(), click()) == ["success", "duplicate"]
    # A failing copy after the success is a duplicate, one before it is an error.
    assert outcomes(spark, view(duration_seconds=-1), view(), view(duration_seconds=-1)) == [
        "error", "success", "duplicate"]
    # Missing keys are checked before duplicates.
    assert outcomes(spark, click(), click(user_id="absent")) == ["success", "invalid"]


def test_first_payload_wins(spark):
    rows = C.classify_rows(deliveries(spark, view(duration_seconds=5), view(duration_seconds=9)))
    assert records(C.first_successes(rows), "duration_seconds") == [(5,)]


def test_ledger_of_an_earlier_run(spark):
    ledger = spark.createDataFrame(
        [("e1", "ClickRegistered", "anime_1", "success", None, None), ("e2", "ClickRegistered", "anime_1", "error", "m", None)],
        S.LEDGER)
    bodies = [click("e1"), click("e2"), click("e3"), view("e1", duration_seconds=-1)]
    assert outcomes(spark, *bodies, ledger=ledger) == ["duplicate", "success", "success", "duplicate"]
    rows = C.classify_rows(deliveries(spark, *bodies))
    assert records(C.drop_processed(rows, ledger), "event_id") == [("e2",), ("e3",)]
    assert records(C.first_successes(rows, ledger), "event_id") == [("e2",), ("e3",)]
    assert project(deliveries(spark, *bodies), ledger=ledger).dead_letters.count() == 0


def test_hot_ids_are_split_without_changing_outcomes(spark):
    bodies = [view("hot", duration_seconds=-1)] * 3 + [view("hot")] * 40 + [click(f"e{i}") for i in range(10)]
    assert outcomes(spark, *bodies) == replay(bodies)["outcomes"]
    rows = C.classify_rows(deliveries(spark, *bodies))
    open_failures = C.outstanding_failures(C.rejected(rows), C.attempts(rows))
    assert records(open_failures, "offset") == [(0,), (1,), (2,)]


def verdicts(spark, *bodies):
    rows = C.classify_rows(deliveries(spark, *bodies))
    return [r.verdict for r in rows.orderBy("offset").collect()]


def test_text_must_be_one_json_object(spark):
    """Trailing text, a second value, single quotes and a missing brace spoil a message; spaces around it do not."""
    good = json.dumps(click("a"))
    bodies = [good + " garbage", good + " " + good, good + "," + good, good + "}", good.replace('"', "'"), good[:-1],
              "[" + good + "]", "", None, "5", " " + good + "\n"]
    assert verdicts(spark, *bodies) == ["invalid"] * 10 + ["ok"]


def test_ids_must_be_strings(spark):
    assert verdicts(spark, click("a", user_id={"x": 1}), click("b", user_id=7), click(5)) == ["error"] * 3


def test_times_with_a_zone_are_converted(spark):
    zones = ["2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00Z", "2023-12-31T19:00:00-0500", "2024-01-01T00:00:00"]
    rows = C.classify_rows(deliveries(spark, *[click(f"e{i}", occurred_at=z) for i, z in enumerate(zones)]))
    assert {(r.verdict, r.occurred_at.isoformat()) for r in rows.collect()} == {("ok", "2024-01-01T00:00:00")}
    assert verdicts(spark, click("a", occurred_at="yesterday")) == ["error"]


def test_order_fails_loudly_beyond_its_range(spark):
    with pytest.raises(Exception, match="beyond the arrival order"):
        C.classify_rows(deliveries(spark, click("a"), start=1 << 42)).select("ord").collect()
