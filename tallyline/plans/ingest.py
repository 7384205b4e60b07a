"""Ingest: commands to versioned events in the log."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators import commands as C
from tallyline.operators.versions import assign_versions
from tallyline.session import materialize
from tallyline.sources import event_log as L


class Ingest(NamedTuple):
    events: DataFrame
    refused: DataFrame


def ingest_commands(commands: DataFrame, catalog: DataFrame, log: DataFrame | None = None) -> Ingest:
    """New versioned events of the accepted commands, and the refused commands with their reasons.

    A resent command gives an event the log already has, so it is dropped before versions are given.
    """
    accepted, refused = _screened(commands, catalog)
    return Ingest(assign_versions(L.new_events(log, accepted), log), refused)


def _screened(commands: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The events of the accepted commands, stored as they are used more than once, and the refused commands."""
    screened = C.screen_commands(commands, catalog)
    return materialize(C.commands_to_events(C.accepted(screened)), "accepted"), C.refused(screened)


def ingest_to_log(spark: SparkSession, commands: DataFrame, catalog: DataFrame, log_path: str,
                  created_at=None) -> Ingest:
    """The same, appended to the log at `log_path` with one commit; `events` are the rows of the log. Several ingests may run at
    one time: each event id is appended once, and versions follow one another. Publishing then reads from the log."""
    accepted, refused = _screened(commands, catalog)

    def rows(version: L.LogVersion) -> DataFrame:
        new = L.new_events(L.known_ids(spark, log_path, version, accepted), accepted)
        return L.log_rows(assign_versions(new, L.read_log(spark, log_path, version)), created_at)

    return Ingest(L.commit_rows(spark, log_path, rows), refused)
