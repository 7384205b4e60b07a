"""Tables merged by bucket. Rows lie in buckets of their key's hash; a manifest names the folders of each bucket.

A run reads and rewrites only the buckets that its rows fall into, and one numbered manifest, created only if its number is free, makes
all its tables visible at once. Of two runs that began on the same manifest one commits; the other begins again on the new one.
"""

import json
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources import files
from tallyline.sources.tables import conform

ATTEMPTS = 20


class Table(NamedTuple):
    schema: T.StructType
    key: tuple[str, ...]


class Manifest(NamedTuple):
    """Of every table the folders of each bucket, as of commit `number`; -1 before the first one. `notes` are those of its run."""

    number: int
    tables: dict[str, dict[str, list[str]]]
    notes: dict


class Changes:
    """What a run has written: folders that replace those of their bucket, or that are added to them."""

    def __init__(self):
        self.replaced: dict[str, dict[str, list[str]]] = {}
        self.added: dict[str, dict[str, list[str]]] = {}
        self.folders: list[str] = []
        self.notes: dict = {}


class BucketedTables:
    """`buckets` is fixed with the first commit: a larger number for larger tables, as a bucket is the least that is rewritten."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table], buckets: int = 64):
        self.spark, self.root, self.tables = spark, root, tables
        first = self._commit_text(0) if files.last_number(spark, f"{root}/commits") >= 0 else None
        self.buckets = json.loads(first)["buckets"] if first else buckets

    def _commit_text(self, number: int) -> str:
        return files.read_number(self.spark, f"{self.root}/commits", number)

    def manifest(self) -> Manifest:
        number = files.last_number(self.spark, f"{self.root}/commits")
        if number < 0:
            return Manifest(number, {}, {})
        told = json.loads(self._commit_text(number))
        return Manifest(number, told["tables"], told["notes"])

    def bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*self.tables[name].key), F.lit(self.buckets)).cast("int")

    def touched(self, name: str, rows: DataFrame) -> list[int]:
        """The buckets that `rows` fall into by the key of table `name`: at most as many numbers as there are buckets."""
        return [r.bucket for r in rows.select(self.bucket(name).alias("bucket")).distinct().collect()]

    def read(self, manifest: Manifest, name: str, only: Iterable[int] | None = None) -> DataFrame:
        """A table as of a manifest, or those buckets of it."""
        own, schema = manifest.tables.get(name, {}), self.tables[name].schema
        chosen = own if only is None else map(str, only)
        folders = [f"{self.root}/{f}" for b in chosen for f in own.get(b, ())]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def write(self, changes: Changes, name: str, rows: DataFrame, add: bool = False) -> None:
        """Write rows by bucket; they take the place of their buckets' rows, or are added to them."""
        folder = f"{name}/{uuid.uuid4().hex}"
        changes.folders.append(folder)
        (conform(rows, self.tables[name].schema).withColumn("bucket", self.bucket(name)).repartition("bucket")
         .sortWithinPartitions("bucket", *self.tables[name].key).write.partitionBy("bucket").parquet(f"{self.root}/{folder}"))
        kind = changes.added if add else changes.replaced
        for part in files.names(self.spark, f"{self.root}/{folder}"):
            kind.setdefault(name, {}).setdefault(part.rpartition("=")[2], []).append(f"{folder}/{part}")

    def written(self, changes: Changes, name: str) -> DataFrame:
        """The rows that took the place of others in this run."""
        return self.read(Manifest(0, changes.replaced, {}), name)

    def current(self, manifest: Manifest, changes: Changes, name: str) -> DataFrame:
        """A table as it will be after this run, rows that are only added left aside."""
        return self.read(Manifest(0, {name: {**manifest.tables.get(name, {}), **changes.replaced.get(name, {})}}, {}), name)

    def _commit(self, manifest: Manifest, changes: Changes) -> bool:
        tables = {name: dict(own) for name, own in manifest.tables.items()}
        for name, own in changes.replaced.items():
            tables.setdefault(name, {}).update(own)
        for name, own in changes.added.items():
            for bucket, folders in own.items():
                mine = tables.setdefault(name, {})
                mine[bucket] = [*mine.get(bucket, ()), *folders]
        text = json.dumps({"buckets": self.buckets, "tables": tables, "notes": {**manifest.notes, **changes.notes}})
        return files.put_number(self.spark, f"{self.root}/commits", manifest.number + 1, text)

    def run(self, step: Callable[[Manifest, Changes], None]) -> Manifest:
        """Run `step` on the last manifest and commit what it wrote; after a lost race its files go and it runs again."""
        for _ in range(ATTEMPTS):
            manifest, changes = self.manifest(), Changes()
            step(manifest, changes)
            if self._commit(manifest, changes):
                return self.manifest()
            for folder in changes.folders:
                files.remove(self.spark, f"{self.root}/{folder}")
        raise RuntimeError(f"{ATTEMPTS} other commits came first")

    def vacuum(self, keep: int = 2) -> None:
        """Remove the folders that none of the last `keep` commits names. For a time when no run is under way."""
        last = files.last_number(self.spark, f"{self.root}/commits")
        used = set()
        for number in range(max(0, last - keep + 1), last + 1):
            for own in json.loads(self._commit_text(number))["tables"].values():
                used |= {f for folders in own.values() for f in folders}
        for name in self.tables:
            for run in files.names(self.spark, f"{self.root}/{name}"):
                for part in files.names(self.spark, f"{self.root}/{name}/{run}"):
                    if f"{name}/{run}/{part}" not in used:
                        files.remove(self.spark, f"{self.root}/{name}/{run}/{part}")
