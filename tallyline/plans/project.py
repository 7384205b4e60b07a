"""Projection in batch: deliveries to activity, statistics, ledger and dead letters."""

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.operators import activity as A
from tallyline.operators import classify as C
from tallyline.operators import dead_letters as D
from tallyline.operators import ledger as G
from tallyline.session import materialize
from tallyline.sources import event_log as L
from tallyline.sources.tables import conform, read_table, write_table


FINISHED = "finished"


class ReadModel(NamedTuple):
    activity: DataFrame
    item_stats: DataFrame
    ledger: DataFrame
    dead_letters: DataFrame


def project(deliveries: DataFrame, now: datetime | None = None, activity: DataFrame | None = None,
            ledger: DataFrame | None = None) -> ReadModel:
    """The read model after `deliveries`, on top of an earlier `activity` and `ledger` if given.

    `now` is the one time of processing written to all tables. `dead_letters` holds the new ones only; the writer
    adds them to the earlier table. The checked deliveries are stored at once; every table is lazy and starts from them.
    """
    stored = check_deliveries(deliveries, now)
    successes = C.first_of_each(C.checked_successes(stored), ledger)
    return assemble(successes, C.checked_rejects(stored), C.checked_attempts(stored), activity, ledger)


def check_deliveries(deliveries: DataFrame, now: datetime | None = None) -> DataFrame:
    """Deliveries after the row checks, parsed once and stored by verdict: what every later step starts from."""
    checked = conform(C.checked(C.classify_rows(deliveries, F.lit(now))), S.CHECKED)
    return materialize(checked, "checked", partition="verdict")


def assemble(successes: DataFrame, rejects: DataFrame, attempts: DataFrame,
             activity: DataFrame | None = None, ledger: DataFrame | None = None) -> ReadModel:
    delta = A.activity(successes)
    merged = delta if activity is None else A.merge_activity(activity, delta)
    entries = G.ledger_entries(attempts)
    return ReadModel(
        merged, A.item_stats(merged),
        entries if ledger is None else G.merge_ledger(ledger, entries),
        D.dead_letters(C.outstanding_failures(rejects, attempts, ledger)),
    )


def write_read_model(deliveries: DataFrame, root: str, now: datetime | None = None,
                     activity: DataFrame | None = None, ledger: DataFrame | None = None,
                     dead_letters: DataFrame | None = None) -> None:
    """Write all tables under `root`, a fresh folder, on top of those of an earlier run if given. Earlier dead letters
    keep their status; letters that are there already are not written again. A marker, written last, makes the
    model readable.

    The raw deliveries are read and parsed once, into `checked`, by verdict; successes and failures
    then come from that narrower table, and the statistics from the written activity.
    """
    spark = deliveries.sparkSession
    write_table(C.checked(C.classify_rows(deliveries, F.lit(now))), root, "checked", partition="verdict")
    stored = read_table(spark, root, "checked")
    write_table(C.first_of_each(C.checked_successes(stored), ledger), root, "successes")
    successes, rejects = read_table(spark, root, "successes"), C.checked_rejects(stored)
    model = assemble(successes, rejects, C.stored_attempts(successes, rejects), activity, ledger)
    write_table(model.activity, root, "activity")
    write_table(A.item_stats(read_table(spark, root, "activity")), root, "item_stats")
    write_table(model.ledger, root, "ledger")
    letters = model.dead_letters if dead_letters is None else D.add_dead_letters(dead_letters, model.dead_letters)
    write_table(letters, root, "dead_letters")
    spark.range(1).write.parquet(f"{root}/{FINISHED}")


def read_read_model(spark: SparkSession, root: str) -> ReadModel:
    """A finished model; one whose writer did not come to its end fails."""
    spark.read.parquet(f"{root}/{FINISHED}")
    return ReadModel(*[read_table(spark, root, name) for name in ReadModel._fields])


def rebuild_read_model(log: DataFrame, now: datetime | None = None) -> ReadModel:
    """Replay the whole event log into a fresh read model, see `as_deliveries` for the order."""
    return project(L.as_deliveries(log), now)
