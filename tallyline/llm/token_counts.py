"""Token counts of whole texts, without keeping the tokens."""

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.text import byte_slices, utf8

BATCH_BYTES = 1 << 20
KEPT_SEGMENTS = 400_000
SAFE = re.compile("(?<=[^ ▁]) (?=[^ ▁])")


def _segments(text: str) -> list[str]:
    """Cuts a text at single spaces between two other characters.

    No piece has a word mark after another character, so no merge crosses such a space, and the mark that the library
    puts before a text stands for the space that was taken out.
    """
    if "  " in text or "▁" in text or text[:1] == " " or text[-1:] == " ":
        return SAFE.split(text)
    return text.split(" ")


class _Pieces:
    """Lengths through a sentencepiece model: equal segments are encoded once, in batches of about equal bytes."""

    def __init__(self, path: str, batch_bytes: int):
        import sentencepiece

        self.model, self.batch_bytes = sentencepiece.SentencePieceProcessor(model_file=path), batch_bytes
        self.lengths: dict[str, int] = {"": 0}
        pieces = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        probe = self.model.encode(["a b  c", "a", "b  c"])
        self.safe = probe[0] == probe[1] + probe[2] and not any("▁" in p.lstrip("▁") for p in pieces)

    def _learn(self, new: list[str]) -> None:
        new.sort(key=len)
        batch, size = [], 0
        for segment in new:
            batch.append(segment)
            size += len(segment)
            if size >= self.batch_bytes:
                self._encode(batch)
                batch, size = [], 0
        self._encode(batch)

    def _encode(self, batch: list[str]) -> None:
        if batch:
            self.lengths.update(zip(batch, map(len, self.model.encode(batch, num_threads=1)), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        cut = [_segments(t) if self.safe else [t] for t in texts]
        if len(self.lengths) > KEPT_SEGMENTS:
            self.lengths = {"": 0}
        self._learn(list(set().union(*cut) - self.lengths.keys()))
        return [sum(map(self.lengths.__getitem__, segments)) for segments in cut]


class _Tokenizer:
    """Lengths through a tokenizers file, whole texts at a time."""

    def __init__(self, path: str, batch_bytes: int):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def count(self, texts: list[str]) -> list[int]:
        return [len(self.model.encode(t, add_special_tokens=False).ids) for t in texts]


@lru_cache(maxsize=2)
def counter_for(path: str, batch_bytes: int) -> _Pieces | _Tokenizer:
    """One counter per Python worker, so that later tasks find its lengths."""
    return (_Pieces if path.endswith(".model") else _Tokenizer)(path, batch_bytes)


def count_tokens(texts: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 4096,
                 batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """`key`, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row, in one pass without a shuffle.

    `path` names a sentencepiece model (.model) or a tokenizers file (.json) that every executor has. No begin, end or
    added special tokens, nothing truncated. A null text counts as empty: 0 bytes, 0 tokens. A null or repeated key is
    carried through, one result per input row; other columns of the input are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(path, batch_bytes)
        for batch in batches:
            for part in byte_slices(batch, "text", 4 * batch_bytes):
                offsets, _ = utf8(part.column("text"))
                yield pa.RecordBatch.from_arrays([
                    part.column("key"), pa.array(np.diff(offsets), pa.int64()),
                    pa.array(counter.count([t or "" for t in part.column("text").to_pylist()]), pa.int64()),
                ], names=["key", "n_bytes", "n_tokens"])

    kind_of_key = texts.schema[key].dataType.simpleString()
    counted = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind_of_key}, n_bytes long, n_tokens long")
    over: Column = F.col("n_tokens") > F.lit(limit)
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", over.alias("over_limit"))
