"""The read model and the catalog as tables merged by bucket: a small run rewrites what it touches, not the whole model."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.operators import activity as A
from tallyline.operators import catalog as K
from tallyline.operators import classify as C
from tallyline.operators import dead_letters as D
from tallyline.operators import leaders as T
from tallyline.operators import ledger as G
from tallyline.operators import reports as R
from tallyline.plans.project import ReadModel, check_deliveries
from tallyline.session import materialize
from tallyline.sources import event_log as L
from tallyline.sources.bucketed import BucketedTables, Changes, Manifest, Table

MODEL = {
    "activity": Table(S.ACTIVITY, ("anime_id", "user_id")),
    "totals": Table(S.ITEM_TOTALS, ("anime_id",)),
    "ledger": Table(S.LEDGER, ("event_id",)),
    "dead_letters": Table(S.DEAD_LETTER, ("dlq_id",)),
    "leaders": Table(S.LEADERS, ("list",)),
}
CATALOG = {"catalog": Table(S.CATALOG, (K.ID,))}


def update_model(deliveries: DataFrame, root: str, now: datetime | None = None, buckets: int = 64) -> Manifest:
    """Add deliveries to the model under `root`; all its tables change with one commit.

    Activity and ledger are merged in the buckets at hand; of the ledger only those are read to know earlier successes. The totals of
    an item change by what its pairs at hand change by. New dead letters are added to their buckets; one that is there already
    is not written again.
    """
    tables = BucketedTables(deliveries.sparkSession, root, MODEL, buckets)
    checked = check_deliveries(deliveries, now)
    return tables.run(lambda manifest, changes: _merge(tables, manifest, changes, checked))


def _merge(tables: BucketedTables, manifest: Manifest, changes: Changes, checked: DataFrame) -> None:
    rejects, attempts = C.checked_rejects(checked), C.checked_attempts(checked)
    ledger = tables.read(manifest, "ledger", tables.touched("ledger", attempts))
    successes = materialize(C.first_of_each(C.checked_successes(checked), ledger), "successes")
    delta = materialize(A.activity(successes), "activity")
    pairs = tables.read(manifest, "activity", tables.touched("activity", delta))
    tables.write(changes, "activity", A.merge_activity(pairs, delta))
    at_hand = delta.select(*A.KEYS)
    old, new = (rows.join(at_hand, A.KEYS, "left_semi") for rows in (pairs, tables.written(changes, "activity")))
    change = materialize(A.totals_change(old, new), "totals")
    totals = tables.read(manifest, "totals", tables.touched("totals", change))
    tables.write(changes, "totals", A.merge_totals(totals, change))
    _rank(tables, manifest, changes, change)
    tables.write(changes, "ledger", G.merge_ledger(ledger, G.ledger_entries(attempts)))
    letters = materialize(D.dead_letters(C.outstanding_failures(rejects, attempts, ledger)), "letters")
    there = tables.read(manifest, "dead_letters", tables.touched("dead_letters", letters)).select("dlq_id")
    tables.write(changes, "dead_letters", letters.join(there, "dlq_id", "left_anti"), add=True)


def _rank(tables: BucketedTables, manifest: Manifest, changes: Changes, change: DataFrame) -> None:
    """Bring the stored top lists up to the totals of this run; their floors are notes of its commit."""
    changed = A.stats_of(tables.written(changes, "totals").join(change, "anime_id", "left_semi")).select(*R.STATS)
    floors, rows = dict(manifest.notes.get("floors", {})), []
    for name in T.LISTS:
        kept = tables.read(manifest, "leaders").where(F.col("list") == name).where("anime_id is not null").select(*R.STATS)
        best, floors[name] = T.updated(
            name, kept, changed, lambda: A.stats_of(tables.current(manifest, changes, "totals")), floors)
        rows += [(name, *[None] * len(R.STATS)), *[(name, *[row[c] for c in R.STATS]) for row in best]]
    tables.write(changes, "leaders", tables.spark.createDataFrame(rows, S.LEADERS))
    changes.notes["floors"] = floors


def read_leaders(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored items of a top list, "views" or "rating", for its report: as good as all statistics for up to
    MAX_REPORT_ROWS rows. A model that has no lists yet gives all statistics."""
    tables = BucketedTables(spark, root, MODEL)
    manifest = tables.manifest()
    if name not in manifest.notes.get("floors", {}):
        return A.stats_of(tables.read(manifest, "totals")).select(*R.STATS)
    return tables.read(manifest, "leaders").where((F.col("list") == name) & F.col("anime_id").isNotNull()).select(*R.STATS)


def catch_up(spark: SparkSession, log_path: str, root: str, now: datetime | None = None, buckets: int = 64) -> Manifest:
    """Bring the model under `root` up to the event log: a replay from the commit of the log that the model holds already.

    The model notes that commit together with its tables, so it is the snapshot that the replay goes on from, and only runs that were
    appended after it are read. Versions must have been assigned, as ingest does: they order the events of an aggregate. The first time everything is read.
    """
    tables = BucketedTables(spark, root, MODEL, buckets)
    version = L.current_version(spark, log_path)
    tail = L.runs_after(spark, log_path, version, tables.manifest().notes.get("log", L.NO_VERSION))
    if not tail.data:
        return tables.manifest()

    def step(manifest: Manifest, changes: Changes) -> None:
        own = L.runs_after(spark, log_path, version, manifest.notes.get("log", L.NO_VERSION))
        checked = check_deliveries(L.versioned_deliveries(L.read_log(spark, log_path, own)), now)
        _merge(tables, manifest, changes, checked)
        changes.notes["log"] = version.number

    return tables.run(step)


def read_model(spark: SparkSession, root: str) -> ReadModel:
    """The model as of its last commit; statistics come from the stored totals."""
    tables = BucketedTables(spark, root, MODEL)
    manifest = tables.manifest()
    activity, totals, ledger, letters = (tables.read(manifest, name) for name in ("activity", "totals", "ledger", "dead_letters"))
    return ReadModel(activity, A.stats_of(totals), ledger, letters)


def update_catalog(updates: DataFrame, root: str, order: str, buckets: int = 64) -> Manifest:
    """Replace or add the items of `updates` in the catalog under `root`; of several rows of an item the last by `order` wins."""
    tables = BucketedTables(updates.sparkSession, root, CATALOG, buckets)
    latest = materialize(K.latest_rows(updates, order), "catalog-updates")

    def step(manifest: Manifest, changes: Changes) -> None:
        old = tables.read(manifest, "catalog", tables.touched("catalog", latest))
        stays = old.join(latest.select(K.ID), K.ID, "left_anti").select(*old.columns)
        tables.write(changes, "catalog", stays.unionByName(latest.select(*old.columns)))

    return tables.run(step)


def read_catalog(spark: SparkSession, root: str) -> DataFrame:
    tables = BucketedTables(spark, root, CATALOG)
    return tables.read(tables.manifest(), "catalog")
