"""Removal of repeated lines with levelled sorted runs of line hashes. DataFrame functions only."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import materialize, run_dir

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Beyond these, lower() may change more than A-Z.
OTHER = "[^\\x00-\\x7F\\xDF-\\xF6\\xF8-\\xFF]"
LOWEST = -(1 << 63)
HASH = ["h1", "h2"]
RUN = "h1 long, h2 long, n long"


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(documents: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(doc, version, place, h1, h2): the lines whose key has at least `min_chars` code points, each hashed once.

    doc is the key, null as the smallest one; version a hash of the text, as rows of one key may have several; place the line's
    number from 0; h1 and h2 the 128 bits of the hash. Each step is a projection of its own, so that none runs twice a line.
    """
    cut = documents.select(_doc(key).alias("doc"), _version(text).alias("version"),
                           F.posexplode(lines_of(F.col(text))).alias("place", "line"))
    bare = cut.select("doc", "version", "place", F.btrim("line", F.lit(WHITE)).alias("bare"))
    own = F.when(F.col("bare").rlike(OTHER), F.translate("bare", UPPER, LOWER)).otherwise(F.lower("bare"))
    keyed = bare.where(F.char_length("bare") >= min_chars).select("doc", "version", "place", own.alias("key"))
    return keyed.select("doc", "version", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def _doc(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(LOWEST))


def _version(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


class LineRuns:
    """Sorted runs of line hashes (h1, h2, n) in levels; `fanout` runs of one level merge into one of the next.

    A new batch is merge-anti-joined with the runs: hashes that no run has make its own run, the others are put down in `again`. So
    each hash stands in one run only, and merging runs sums nothing. A run is a table bucketed and sorted by hash: the joins
    read it in its order, without a shuffle. Runs lie in the shared folder; `close` takes their names out of the catalog.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.path: dict[str, str] = {}
        self.again = spark.createDataFrame([], RUN)

    def _write(self, run: DataFrame, level: int) -> str:
        name, path = f"line_run_{uuid.uuid4().hex}", run_dir(self.spark, f"line-run-{level}")
        run.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        self.path[name] = path
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return name

    def _names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _all(self, names: list[str]) -> DataFrame:
        """The rows of several runs, read as plain files: a union of bucketed tables may be grouped without a shuffle
        though the planner reads their files in another order."""
        if not names:
            return self.spark.createDataFrame([], RUN)
        return self.spark.read.schema(RUN).parquet(*[self.path[n] for n in names])

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """The hashes that no run holds, by a merge anti-join with each run."""
        for name in self._names():
            hashes = hashes.join(self.spark.table(name).select(*HASH), HASH, "left_anti")
        return hashes

    def add(self, lines: DataFrame) -> None:
        """Add a batch of lines (h1, h2)."""
        own = materialize(lines.groupBy(*HASH).agg(F.count("*").alias("n")), "line-batch")
        first = not self._names()
        new = self._write(self.unseen(own), 0)
        if not first:
            seen = own.join(self.spark.table(new).select(*HASH), HASH, "left_anti")
            self.again = self.again.unionByName(materialize(seen, "line-again"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            self._write(self._all(names), level + 1)
            self._drop(names)
            level += 1

    def frequent(self, least: int) -> DataFrame:
        """(h1, h2) of the hashes with at least `least` lines."""
        runs = self._all(self._names())
        later = self.again.groupBy(*HASH).agg(F.sum("n").alias("_later"))
        return runs.join(later, HASH, "left").where(F.col("n") + F.coalesce("_later", F.lit(0)) >= least).select(*HASH)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self._drop(self._names())


def drop_repeated_lines(documents: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4,
                        fanout: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`documents` with repeated lines taken out of `text`, and the columns `n_lines` and `n_dropped` added.

    Lines are cut at \\n; a line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least
    `min_chars` code points found under at least `min_docs` different `key`s lose all their lines except in the largest `key`
    holding it; other lines stay, joined by \\n. Rows of one key count as one document, and those of the largest key all keep the
    line. A null key counts as the smallest one. A null text has one empty line and comes back empty. Other columns are kept as
    they are; input columns n_lines and n_dropped would be replaced.

    Each line is hashed once, to 128 bits, and known by its number from then on. Documents go in `batches` through the runs, which
    tell the hashes that may be frequent enough; only their lines are counted by document and looked up again.
    """
    spark = documents.sparkSession
    path = run_dir(spark, "line-hashes")
    (line_hashes(documents, key, text, min_chars)
     .withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(path))
    lines = spark.read.schema("doc long, version long, place int, h1 long, h2 long, batch int").parquet(path)
    runs = LineRuns(spark, fanout)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch).select(*HASH))
    frequent = materialize(runs.frequent(min_docs), "line-frequent")
    runs.close()
    held = materialize(lines.drop("batch").join(frequent, HASH), "line-held")
    by_line = held.groupBy(*HASH, "doc").count().groupBy(*HASH).agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc"))
    # Stored, so that the join with it can be split where one line fills a partition.
    repeated = materialize(by_line.where(F.col("n_docs") >= min_docs).select(*HASH, "last_doc"), "line-repeated")
    lost = (held.join(repeated, HASH).where(F.col("doc") < F.col("last_doc"))
            .groupBy(F.col("doc").alias("_lost_doc"), F.col("version").alias("_lost_version"))
            .agg(F.collect_set("place").alias("_lost")))
    rows = documents.drop("n_lines", "n_dropped")
    joined = rows.join(lost, (_doc(key) == F.col("_lost_doc")) & (_version(text) == F.col("_lost_version")), "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    n_lines = F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    # Places that stay come from a set difference, so a document of many lost lines takes time in proportion to its lines. The generator
    # of one row keeps the optimizer from moving the split into the lambda, where it would run for every line.
    stays = F.when(F.col("_lost").isNotNull(), F.array_except(F.sequence(F.lit(0), F.col("_n") - 1), "_lost"))
    cut = F.when(F.col("_lost").isNotNull(), lines_of(F.col(text)))
    counted = joined.withColumn("_n", n_lines).select("*", F.explode(F.array(F.struct(cut.alias("cut"), stays.alias("stays")))).alias("_w"))
    kept = F.array_join(F.transform("_w.stays", lambda i: F.get(F.col("_w.cut"), i)), "\n")
    out = F.when(F.col("_lost").isNull(), whole).otherwise(kept)
    return counted.select(*[out.alias(c) if c == text else F.col(c) for c in rows.columns],
                          F.col("_n").cast("long").alias("n_lines"),
                          F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"))
