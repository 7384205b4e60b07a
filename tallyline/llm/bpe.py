"""Exact byte-pair encoding by a table over prefixes, and decoding.

A word's encoding is found from left to right. For every prefix exactly one token can come last: a token that ends the
prefix and goes well with the last token of the shorter prefix before it. An automaton over the vocabulary lists the
tokens that end at each place; a test on pairs tells which one goes well; back-pointers then give the ids.
"""

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import worker
from tallyline.llm.text import byte_slices

SLICE_BYTES = 1 << 20
KEPT_WORDS = 300_000
KEPT_PREFIXES = 300_000
KEPT_PAIRS = 300_000
LONGEST_KEPT = 48
END = 256
#: Letters and digits below U+0250, where lower case goes character by character and composition changes nothing.
PLAIN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿĀ-ɏ]+"
    "|[0-9²³¹¼-¾]"
    "|[^\t-\r \u0085 a-zªµºß-öø-ÿĀ-ɏ"
    "0-9²³¹¼-¾]+")
BEYOND = re.compile("[ɐ-\U0010ffff]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class SuffixAutomaton:
    """For every prefix read so far, the vocabulary's strings that are suffixes of it, longest first."""

    def __init__(self, words: dict[str, int]):
        self.edge: dict[tuple[int, str], int] = {}
        children: list[list[tuple[str, int]]] = [[]]
        found: list[tuple[tuple[int, int], ...]] = [()]
        for word, value in words.items():
            state = 0
            for symbol in word:
                following = self.edge.get((state, symbol))
                if following is None:
                    following = self.edge[state, symbol] = len(found)
                    children[state].append((symbol, following))
                    children.append([])
                    found.append(())
                state = following
            found[state] = ((value, len(word)),)
        self.link, self.found = [0] * len(found), found
        level = [0]
        while level:
            below = []
            for state in level:
                for symbol, child in children[state]:
                    if state:
                        self.link[child] = self.step(self.link[state], symbol)
                    found[child] += found[self.link[child]]
                    below.append(child)
            level = below

    def step(self, state: int, symbol: str) -> int:
        while (following := self.edge.get((state, symbol))) is None:
            if not state:
                return 0
            state = self.link[state]
        return following


class PrefixEncoder:
    """Encodes single words of a byte-level vocabulary whose last symbol carries an end mark."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]], suffix: str):
        self.code = {s: chr(b) for b, s in enumerate(byte_symbols())}
        self.suffix = suffix
        self.join: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, (left, right) in enumerate(merges):
            whole = vocab[left + right]
            self.join[vocab[left], vocab[right]] = whole
            self.parts[whole] = (vocab[left], vocab[right])
            self.rank[whole] = rank
        if len(self.rank) != len(merges):
            raise ValueError("a token with two merges has no unique decomposition")
        self.automaton = SuffixAutomaton({self._own(token): i for token, i in vocab.items()})
        self.good: dict[tuple[int, int], bool] = {}
        self.table: dict[str, tuple[int, int, int]] = {}

    def _own(self, token: str) -> str:
        ends = token.endswith(self.suffix)
        own = "".join(map(self.code.__getitem__, token[:-len(self.suffix)] if ends else token))
        return own[:-1] + chr(ord(own[-1]) + END) if ends else own

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens in rank order leaves exactly these two tokens.

        Merges are undone from the latest to the earliest along the seam. The pair that faces the seam at any moment
        must not have a merge that would have come before the next one undone so far.
        """
        a, b, before = left, right, len(self.rank) + 1
        rank = self.rank
        while True:
            whole = self.join.get((a, b))
            if whole is not None and rank[whole] < before:
                return False
            of_a, of_b = rank.get(a, -1), rank.get(b, -1)
            if of_a < 0 and of_b < 0:
                return True
            # On a tie of rank the left copy is merged first, so the right one is undone first.
            if of_a > of_b:
                a, before = self.parts[a][1], of_a
            else:
                b, before = self.parts[b][0], of_b + 1

    def _fits(self, left: int, right: int) -> bool:
        fits = self.good.get((left, right))
        if fits is None:
            if len(self.good) > KEPT_PAIRS:
                self.good.clear()
            fits = self.good[left, right] = self.compatible(left, right)
        return fits

    def _last(self, prefix: str, end: str, state: int) -> tuple[int, int, int]:
        """State, last token and its length for `prefix` + `end`, from the table of the shorter prefixes."""
        state = self.automaton.step(state, end)
        size, table = len(prefix) + 1, self.table
        for token, length in self.automaton.found[state]:
            if length == size or self._fits(table[prefix[:size - length]][1], token):
                return state, token, length
        raise ValueError("no token ends this prefix")

    def encode(self, word: bytes) -> list[int]:
        """The ids of one non-empty word. What the table has of prefixes of earlier words is not worked out again."""
        own = word.decode("latin-1")
        size, table = len(own), self.table
        if size > LONGEST_KEPT:
            return self._encode_long(own)
        if len(table) > KEPT_PREFIXES:
            table.clear()
        known = size - 1
        while known and own[:known] not in table:
            known -= 1
        state = table[own[:known]][0] if known else 0
        for n in range(known + 1, size):
            table[own[:n]] = entry = self._last(own[:n - 1], own[n - 1], state)
            state = entry[0]
        _, token, length = self._last(own[:-1], chr(ord(own[-1]) + END), state)
        out, at = [token], size - length
        while at:
            _, token, length = table[own[:at]]
            out.append(token)
            at -= length
        return out[::-1]

    def _encode_long(self, own: str) -> list[int]:
        """The same with a table by length, for a word whose prefixes are too long to keep as strings."""
        own = own[:-1] + chr(ord(own[-1]) + END)
        back, width, state = [-1], [0], 0
        for n, symbol in enumerate(own, 1):
            state = self.automaton.step(state, symbol)
            token, length = next((t, k) for t, k in self.automaton.found[state] if k == n or self._fits(back[n - k], t))
            back.append(token)
            width.append(length)
        out, at = [], len(own)
        while at:
            out.append(back[at])
            at -= width[at]
        return out[::-1]


class WordBpe:
    """Encodes and decodes whole texts as the tokenizers file does, without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.library = Tokenizer.from_file(path)
        self.words = PrefixEncoder(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.token = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.byte = {s: b for b, s in enumerate(byte_symbols())}
        self.known: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        """Words of one text as the file's normalizer and splitter give them."""
        low = text.lower()
        # Some capitals below U+0250 have small letters beyond it.
        return self._exotic(text) if BEYOND.search(low) else PLAIN.findall(low)

    def _exotic(self, text: str) -> list[str]:
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte.__getitem__, piece)).decode("utf-8") for piece, _ in cut]

    def _ids(self, words: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = array("i", self.words.encode(word.encode("utf-8"))).tobytes()
        return list(map(known.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        out: list[bytes] = []
        for k, part in enumerate(self.split.split(text) if self.split else [text]):
            out += [array("i", [self.special[part]]).tobytes()] if k % 2 else self._ids(self._pieces(part))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, which is what a file without a decoder asks for."""
        return " ".join(map(self.token.__getitem__, ids))


def coder_for(path: str) -> WordBpe:
    """One coder per Python worker, so that later tasks find its tables filled."""
    return worker.kept(("bpe", path), lambda: WordBpe(path))


def encode(texts: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, ids (array of int) and decoded (the text decoded from these ids) of every row, in one pass.

    Strings of special tokens inside a text become their ids, as the library's default has it. A null text counts as
    empty: no ids, empty decoded text. A null or repeated key is carried through, one result per input row; other columns
    are left out. Rows are worked on in slices of bounded bytes, a long text as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(path)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                ids = [coder.encode(t or "") for t in part.column("text").to_pylist()]
                bounds = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("key"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids))),
                    pa.array([coder.decode(i.tolist()) for i in ids], pa.string()),
                ], names=["key", "ids", "decoded"])

    kind = texts.schema[key].dataType.simpleString()
    return texts.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)
