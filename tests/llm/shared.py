"""Rows that every operator on texts has to take."""

import re

import numpy as np
import pyarrow as pa

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, n_tokens string, ids string, severity string, rejected string, n_lines string, row string, size string"

LONG = " ".join(f"Wörd{i % 977}" for i in range(120_000))
TEXTS = [None, "", " ", "\n\n", "one", "ONE  two\tthree\n", "a" * 100_000, LONG, "<|endoftext|> </s> [INST]", "▁ x ▁▁y",
         "日本語 text 😀 É é", "ab\x00cd\x1f", "same text here for all of us", "same text here for all of us"]


def frame(spark, texts=TEXTS, start=0):
    """Texts with ids, a repeated row, a null id and columns whose names the operators use themselves."""
    rows = [(start + i, t, *["x"] * 7) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "a text without an id that is long enough", *[None] * 7)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def reordered(df):
    """`df` with its rows in another order on each scan."""

    def run(batches):
        rows = pa.Table.from_batches(batches)
        if rows.num_rows:
            yield from rows.take(pa.array(np.random.default_rng().permutation(rows.num_rows))).to_batches()

    return df.coalesce(1).mapInArrow(run, df.schema)


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
