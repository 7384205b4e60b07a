"""Helpers that work on whole Arrow string columns: byte views, slices of bounded size, word and shingle hashes."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a word up to which words are hashed together.
SHORT = 64
ALL_BITS = np.uint64(0xFFFFFFFFFFFFFFFF)
SPACE = np.array([9, 10, 11, 12, 13, 32])
#: ASCII other than letters and digits.
NOT_LETTERS = np.array([b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and bytes of a string or binary column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return at - at[0], raw[at[0]:at[-1]]


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of `batch` in slices of at most `limit` bytes of `column`; a longer row comes alone."""
    offsets, _ = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words of many texts at once.

    A word is a maximal run of bytes that `separators` does not hold; A-Z count as a-z. A short word is mixed in blocks of
    eight bytes, every block through `mix`, all words of a batch together; a longer one by BLAKE2.
    """

    def __init__(self, separators: np.ndarray = SPACE):
        self.is_word = np.ones(256, bool)
        self.is_word[separators] = False
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def bounds(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last byte of every word; a row's end ends its word."""
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = self.is_word[data]
        begin, end = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
        cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        begin[cut] |= word[cut + 1]
        end[cut - 1] |= word[cut]
        return np.flatnonzero(begin), np.flatnonzero(end) + 1

    def hashes(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        folded = np.concatenate([self.fold[data], np.zeros(8, np.uint8)])
        eight = np.ndarray(len(data) + 1, np.dtype("<u8"), folded, strides=(1,))
        length = (last - first).astype(np.int64)
        out = np.full(len(first), 0x9E3779B97F4A7C15, np.uint64)
        left = np.flatnonzero(length <= SHORT)
        with np.errstate(over="ignore"):
            for k in range(0, SHORT, 8):
                left = left[length[left] > k]
                if not len(left):
                    break
                spare = 8 - np.minimum(length[left] - k, 8)
                block = eight[first[left] + k] & (ALL_BITS >> (8 * spare).astype(np.uint64))
                out[left] = mix(out[left] * np.uint64(0xD6E8FEB86659FD93) + block)
            out = mix(out + length.astype(np.uint64))
        for i in np.flatnonzero(length > SHORT):
            digest = hashlib.blake2b(folded[first[i]:last[i]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
        return out

    def words(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of every word, its first byte, and the index of each row's first word (rows + 1 values)."""
        first, last = self.bounds(offsets, data)
        return self.hashes(data, first, last), first, np.searchsorted(first, offsets)


def shingles(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row in ascending order, and where each row's begin.

    A row of fewer than `width` words gives its whole sequence as one shingle, a row without words none.
    """
    n_rows, counts = len(rows) - 1, np.diff(rows)
    owner = np.repeat(np.arange(n_rows), counts)
    with np.errstate(over="ignore"):
        n = max(len(words) - width + 1, 0)
        value = np.zeros(n, np.uint64)
        for k in range(width):
            value = mix(value * np.uint64(0xD6E8FEB86659FD93) + words[k:k + n])
        inside = owner[:n] == owner[width - 1:width - 1 + n] if n else np.zeros(0, bool)
        value, of = value[inside], owner[:n][inside]
        short = np.flatnonzero((counts > 0) & (counts < width))
        extra = []
        for r in short:
            h = np.zeros(1, np.uint64)
            for w in words[rows[r]:rows[r + 1]]:
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w)
            extra.append(mix(h + np.uint64(counts[r])))
    if extra:
        value, of = np.concatenate([value, *extra]), np.concatenate([of, short])
        of_order = np.argsort(of, kind="stable")
        value, of = value[of_order], of[of_order]
    begin = np.searchsorted(of, np.arange(n_rows + 1))
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        value[a:b].sort()
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[fresh], np.concatenate([[0], np.cumsum(fresh)])[begin]


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column over a flat value array."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values).cast(kind, safe=False))
