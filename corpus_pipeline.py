"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input."""

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from tallyline.llm.queries import bpe_digests
from tallyline.session import materialize, numbered, recorded_dirs
from tallyline.sources import files


def _keeping_columns(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `stage` keeps of `docs`, with the columns of `docs`: those besides doc_id and text have names of their own
    meanwhile, so that none clashes with a column of an operator."""
    names = {c: c if c in ("doc_id", "text") else f"_own_{i}" for i, c in enumerate(docs.columns)}
    kept = stage(docs.select(*[F.col(f"`{c}`").alias(own) for c, own in names.items()]))
    return kept.select(*[F.col(own).alias(c) for c, own in names.items()])


_made: list[str] = []


def _stage(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that first removes the intermediate tables of the one before: its own input is that one's output, written and
    reread, so nothing reads them any more."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _made:
            files.remove(spark, _made.pop())
        with recorded_dirs() as made:
            out = step(spark, docs, sf_dir)
        _made.extend(made)
        return out

    return run_step


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labels, does not reject."""
    labels = toxicity.severity_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = toxicity.fit(docs, labels)
    return _keeping_columns(docs, lambda own: toxicity.score(own, model).where(~F.col("rejected")))


@_stage
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that at least three of them hold but for the last; n_chars follows the text."""
    kept = _keeping_columns(docs, line_dedup.drop_repeated_lines)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return _keeping_columns(docs, lambda own: ngram_join.one_of_each_group(own, width=5, percent=80))


@_stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")

    def clean(own: DataFrame) -> DataFrame:
        rows = numbered(own, "corpus-texts")
        found = decontaminate.contaminated_passages(rows, benchmark, key="_row").select("_row").distinct()
        return rows.join(found, "_row", "left_anti")

    return _keeping_columns(docs, clean)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of what they decode to."""
    return bpe_digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("bpe", encode),
]
#: The severity model and the latent space are not SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
