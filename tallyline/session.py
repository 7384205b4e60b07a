"""Session settings and the shared folder for intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tallyline",
                  **conf) -> SparkSession:
    """A local session for tests and the bench; on a cluster the job gets its session from outside."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, from spark.checkpoint.dir; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    made = tempfile.mkdtemp(prefix="tallyline-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared folder."""
    path = f"{shared_dir(spark)}/tallyline/{name}-{uuid.uuid4().hex}"
    for made in _recorders:
        made.append(path)
    return path


_recorders: list[list[str]] = []


@contextmanager
def recorded_dirs() -> Iterator[list[str]]:
    """The folders that `run_dir` names meanwhile: whoever knows that no result reads them any more can remove them."""
    made: list[str] = []
    _recorders.append(made)
    try:
        yield made
    finally:
        _recorders.remove(made)


def materialize(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder, by `partition` if given, and read it back: cuts lineage, survives executor loss."""
    path = run_dir(df.sparkSession, name)
    (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, column: str = "_row") -> DataFrame:
    """`df` with a number for each row, written once: worked out anew on another scan the numbers may fall differently."""
    return materialize(df.withColumn(column, F.monotonically_increasing_id()), name)
