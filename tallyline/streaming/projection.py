"""The projection as Structured Streaming: the same tables as the batch plan, kept up to date.

One query, one `foreachBatch`. A micro-batch is parsed once, into `checked`; the steps of the batch plan then run on that stored
table, and everything they publish becomes visible with one marker. A batch that runs again before its marker replaces its own
folders, one after it does nothing.

What a later batch must know of an event id is that it has succeeded. That state is a table of its own: two hashes of the id and
the place of its first success, 24 bytes, never a payload. A batch looks up its own ids only: deltas since the last compaction are
read as they are, and of the compacted state the buckets that the ids at hand fall into. Ids are never forgotten.

Layout under `root`: progress/N (markers), <table>/batch_id=N (deltas), base/<table>/upto=N, base_done/N, marks/.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyline import schemas as S
from tallyline.operators import activity as A
from tallyline.operators import classify as C
from tallyline.operators import dead_letters as D
from tallyline.operators import ledger as G
from tallyline.plans.project import ReadModel
from tallyline.sources import files
from tallyline.sources.tables import conform

NONE = -1
ID_BUCKETS = 64
# Published by batch; folded by compaction.
DELTAS = {"successes": S.SUCCESS, "ids": S.SUCCEEDED_ID, "activity": S.ACTIVITY, "rejects": S.REJECT, "counters": S.COUNTER}
BASES = {"ids": S.SUCCEEDED_ID, "activity": S.ACTIVITY, "ledger": S.LEDGER, "dead_letters": S.DEAD_LETTER, "counters": S.COUNTER}
WORKING = {"checked": S.CHECKED, "known": S.KNOWN_ID}


def prepare(spark: SparkSession, root: str) -> None:
    """Empty tables, so that readers work before the first batch; keeps what is there."""
    tables = {f"{name}/batch_id={NONE}": schema for name, schema in DELTAS.items()}
    tables |= {f"base/{name}/upto={NONE}": schema for name, schema in BASES.items()} | {"marks": S.MARK}
    there = set(files.names(spark, root))
    for path, schema in tables.items():
        if path.split("/")[0] not in there or path.startswith("base") and not files.names(spark, f"{root}/{path.rpartition('/')[0]}"):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/{path}")


def _hashed(ids: DataFrame) -> DataFrame:
    """`ids` with the hashes that the state keeps of event_id, and its bucket."""
    first = F.xxhash64("event_id")
    return ids.withColumns({"h1": first, "h2": F.xxhash64(F.lit(1), "event_id"),
                            "bucket": F.pmod(first, F.lit(ID_BUCKETS)).cast("int")})


def _deltas(spark: SparkSession, root: str, name: str, after: int, upto: int) -> DataFrame:
    schema = T.StructType([*DELTAS[name].fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{root}/{name}")
    return rows.where((F.col("batch_id") > after) & (F.col("batch_id") <= upto)).drop("batch_id")


def _base(spark: SparkSession, root: str, name: str, upto: int) -> DataFrame:
    schema = BASES[name]
    if name == "ids":
        schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{root}/base/{name}/upto={upto}")


def succeeded_before(spark: SparkSession, root: str, rows: DataFrame, batch_id: int) -> DataFrame:
    """(event_id): those ids of `rows` that succeeded in a batch before this one. Of the compacted ids only the buckets at hand
    are read; their numbers, at most ID_BUCKETS, come to the driver."""
    upto = files.last_number(spark, f"{root}/base_done")
    ids = _hashed(rows.where(F.col("event_id").isNotNull()).select("event_id").distinct())
    at_hand = [r.bucket for r in ids.select("bucket").distinct().collect()]
    base = _base(spark, root, "ids", upto).where(F.col("bucket").isin(at_hand))
    in_base = ids.join(base.drop("ord"), ["bucket", "h1", "h2"], "left_semi")
    in_deltas = ids.join(_deltas(spark, root, "ids", upto, batch_id - 1).drop("ord"), ["h1", "h2"], "left_semi")
    return in_base.select("event_id").unionByName(in_deltas.select("event_id"))


def count_outcomes(checked: DataFrame, successes: DataFrame, outstanding: DataFrame) -> DataFrame:
    """Deliveries of a batch by type and outcome, without a look at each of them: those that reached the checks of an id and are
    neither its success nor an outstanding failure are duplicates."""
    kind = F.coalesce("event_type", F.lit("unknown")).alias("event_type")

    def counted(rows: DataFrame, outcome: Column, sign: int = 1) -> DataFrame:
        return rows.groupBy(kind, outcome.alias("outcome")).agg((F.count("*") * sign).alias("deliveries"))

    reached, failed = F.col("verdict").isin("ok", "error"), outstanding.where(F.col("verdict") == "error")
    parts = [counted(checked, F.when(reached, "duplicate").otherwise(F.col("verdict"))),
             counted(successes, F.lit("success")), counted(successes, F.lit("duplicate"), -1),
             counted(failed, F.lit("error")), counted(failed, F.lit("duplicate"), -1)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return _summed(whole).where(F.col("deliveries") > 0)


def _summed(counters: DataFrame) -> DataFrame:
    return counters.groupBy("event_type", "outcome").agg(F.sum("deliveries").alias("deliveries"))


class _Batch:
    """The steps of one micro-batch, each written to a folder of its own."""

    def __init__(self, spark: SparkSession, root: str, batch_id: int):
        self.spark, self.root, self.batch_id = spark, root, batch_id

    def _stored(self, df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
        schema = {**DELTAS, **WORKING}[name]
        path = f"{self.root}/{name}/batch_id={self.batch_id}"
        writer = conform(df, schema).write.mode("overwrite")
        (writer.partitionBy(partition) if partition else writer).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def publish(self, new: DataFrame) -> None:
        spark, root, batch_id = self.spark, self.root, self.batch_id
        # The only step that runs the stream's plan, with its parsing; the session of the later ones may re-plan joins.
        checked = self._stored(new, "checked", partition="verdict")
        reached = checked.where(F.col("verdict").isin("ok", "error"))
        known = self._stored(succeeded_before(spark, root, reached, batch_id), "known")
        done = known.withColumn("status", F.lit("success"))
        first = C.first_of_each(C.checked_successes(checked)).join(known, "event_id", "left_anti")
        successes = self._stored(first, "successes")
        self._stored(_hashed(successes.select("event_id", "ord")), "ids")
        self._stored(A.activity(successes), "activity")
        rejects = self._stored(
            C.outstanding_failures(C.checked_rejects(checked), C.checked_attempts(checked), done), "rejects")
        self._stored(count_outcomes(checked, successes, rejects), "counters")
        files.put_number(spark, f"{root}/progress", batch_id)
        for name in WORKING:
            files.remove(spark, f"{root}/{name}/batch_id={batch_id}")


def run_projection_stream(deliveries: DataFrame, root: str, checkpoint: str, compact_every: int | None = None,
                          **trigger) -> StreamingQuery:
    """Start the query over a stream of deliveries. `trigger` as for `DataStreamWriter.trigger`; without one, micro-batches
    follow one another. With `compact_every` the model is compacted after each so many batches."""
    spark = deliveries.sparkSession
    prepare(spark, root)
    rows = conform(C.checked(C.classify_rows(deliveries, F.current_timestamp())), S.CHECKED)

    def write(new: DataFrame, batch_id: int) -> None:
        if batch_id > files.last_number(spark, f"{root}/progress"):
            _Batch(spark, root, batch_id).publish(new)
            if compact_every and (batch_id + 1) % compact_every == 0:
                compact(spark, root)

    writer = rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


# ---- reading ---------------------------------------------------------------------------


def _tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table of the model as of the last finished micro-batch: the compacted base and the deltas after it."""
    upto, done = files.last_number(spark, f"{root}/base_done"), files.last_number(spark, f"{root}/progress")
    base = {name: _base(spark, root, name, upto) for name in BASES}
    delta = {name: _deltas(spark, root, name, upto, done) for name in DELTAS}
    entries = G.ledger_entries(C.stored_attempts(delta["successes"], delta["rejects"]))
    return {
        "activity": A.merge_activity(base["activity"], delta["activity"]),
        "ledger": G.merge_ledger(base["ledger"], entries),
        "dead_letters": base["dead_letters"].unionByName(D.dead_letters(delta["rejects"])),
        "counters": _summed(base["counters"].unionByName(delta["counters"])),
        "ids": base["ids"].drop("bucket").unionByName(delta["ids"]),
    }


def compact(spark: SparkSession, root: str) -> int:
    """Fold the finished deltas into a new base; readers switch to it when its marker is there.

    What the base before this one has folded already is removed then: a reader that began on that base still finds all it needs.
    """
    done, before = files.last_number(spark, f"{root}/progress"), files.last_number(spark, f"{root}/base_done")
    if done <= before:
        return done
    for name, table in _tables(spark, root).items():
        path, rows = f"{root}/base/{name}/upto={done}", conform(table, BASES[name])
        if name == "ids":
            bucket = F.pmod("h1", F.lit(ID_BUCKETS)).cast("int")
            rows.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", "h1").write.mode(
                "overwrite").partitionBy("bucket").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)
    files.put_number(spark, f"{root}/base_done", done)
    _retire(spark, root, before)
    return done


def _retire(spark: SparkSession, root: str, upto: int) -> None:
    """Remove deltas up to `upto`, and bases and markers below it."""
    for name in DELTAS:
        for folder in files.names(spark, f"{root}/{name}"):
            if NONE < int(folder.rpartition("=")[2]) <= upto:
                files.remove(spark, f"{root}/{name}/{folder}")
    for name in BASES:
        for folder in files.names(spark, f"{root}/base/{name}"):
            if int(folder.rpartition("=")[2]) < upto:
                files.remove(spark, f"{root}/base/{name}/{folder}")
    files.remove_numbers_below(spark, f"{root}/base_done", upto)
    files.remove_numbers_below(spark, f"{root}/progress", upto)


def read_stream_model(spark: SparkSession, root: str) -> ReadModel:
    """The read model as of the last finished micro-batch, with the marks set on its dead letters."""
    tables = _tables(spark, root)
    marks = spark.read.schema(S.MARK).parquet(f"{root}/marks")
    return ReadModel(tables["activity"], A.item_stats(tables["activity"]), tables["ledger"],
                     D.apply_marks(tables["dead_letters"], marks))


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """Deliveries so far by type and outcome, see `processing_summary`."""
    return G.with_counter(_tables(spark, root)["counters"])


def mark_letters(spark: SparkSession, root: str, marks: DataFrame) -> None:
    """Append marks (`retry_marks`, `resolve_marks`) for the stored dead letters."""
    conform(marks, S.MARK).write.mode("append").parquet(f"{root}/marks")
