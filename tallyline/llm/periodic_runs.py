"""Periodic runs of words, found with a suffix automaton and link-cut access, and texts collapsed to one period of each.

Words are taken in order. The suffix links of the automaton are a tree; the path from a prefix's state to the root holds all
suffixes of that prefix. Each path segment carries the place where its suffixes last ended, kept as the preferred paths of a
link-cut tree. The access of the next prefix walks the segments of its path and gives them the new end. A segment whose last
end lies d words back and whose longest suffix has at least d words shows a square of period d, and the whole stretch of that
period: the longest common suffix of both ends, d words longer. The last end of a long enough suffix is never further back than
the smallest period, so each stretch comes with its smallest one; its last report is the maximal run.
"""

from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.text import byte_slices

SLICE_BYTES = 4 << 20
NARROWINGS = 32
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _automaton(word: list[int]) -> tuple[array, array, array]:
    """Suffix links and longest lengths of the automaton's states, and the state of every prefix.

    Most states have one transition, which stands in two arrays; further ones go to a dictionary of the state.
    """
    most = 2 * len(word) + 2
    link, size, symbol, target = (array("q", [-1]) * most for _ in range(4))
    more: dict[int, dict[int, int]] = {}
    prefix = array("q", [0]) * len(word)
    size[0] = 0
    last, states = 0, 1
    for i, c in enumerate(word):
        new = prefix[i] = states
        states += 1
        size[new] = i + 1
        p, q = last, -1
        while p >= 0:
            s = symbol[p]
            if s == c:
                q = target[p]
                break
            if s < 0:
                symbol[p], target[p] = c, new
            else:
                own = more.get(p)
                if own is None:
                    more[p] = {c: new}
                elif c in own:
                    q = own[c]
                    break
                else:
                    own[c] = new
            p = link[p]
        last = new
        if q < 0:
            link[new] = 0
        elif size[q] == size[p] + 1:
            link[new] = q
        else:
            clone = states
            states += 1
            size[clone], link[clone] = size[p] + 1, link[q]
            symbol[clone], target[clone] = symbol[q], target[q]
            if q in more:
                more[clone] = dict(more[q])
            while p >= 0:
                if symbol[p] == c:
                    if target[p] != q:
                        break
                    target[p] = clone
                elif p in more and more[p].get(c) == q:
                    more[p][c] = clone
                else:
                    break
                p = link[p]
            link[q] = link[new] = clone
    return link, size, prefix


class LastEnds:
    """Preferred paths of a link tree: each is a splay tree by depth and has the end that its suffixes share.

    `above[x]` is the parent inside the splay tree or, at its root, the state above the path. State 0, the empty suffix,
    stays outside.
    """

    def __init__(self, link: array):
        self.above = array("q", [x if x > 0 else -1 for x in link])
        self.left, self.right, self.end = (array("q", [-1]) * len(link) for _ in range(3))

    def _splay(self, x: int) -> None:
        above, left, right = self.above, self.left, self.right
        p = above[x]
        top = -1
        while p >= 0 and (left[p] == x or right[p] == x):
            top = p
            g = above[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            if inner:
                top = g
                if (left[g] == p) == (left[p] == x):
                    self._rotate(p, g)
                else:
                    self._rotate(x, p)
                    p = g
            self._rotate(x, p)
            p = above[x]
        if top >= 0:
            self.end[x] = self.end[top]

    def _rotate(self, x: int, p: int) -> None:
        above, left, right = self.above, self.left, self.right
        g = above[p]
        if left[p] == x:
            inside = left[p] = right[x]
            right[x] = p
        else:
            inside = right[p] = left[x]
            left[x] = p
        if inside >= 0:
            above[inside] = p
        above[p], above[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, state: int, place: int) -> Iterator[tuple[int, int]]:
        """(deepest state, last end) of each segment from `state` to the root; the whole path then ends at `place`."""
        below, x = -1, state
        while x >= 0:
            self._splay(x)
            if self.end[x] >= 0:
                yield x, self.end[x]
            lower = self.right[x]
            if lower >= 0:
                self.end[lower] = self.end[x]
            self.right[x] = below
            below, x = x, self.above[x]
        self.end[below] = place


def runs_of(word: list[int], min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the maximal runs of at least `min_length` words and `min_exponent` >= 2 periods."""
    link, size, prefix = _automaton(word)
    ends = LastEnds(link)
    found: dict[tuple[int, int], int] = {}
    for place, state in enumerate(prefix):
        for deepest, end in ends.access(state, place):
            period = place - end
            length = size[deepest] + period
            if length >= min_exponent * period and length >= min_length:
                found[place - length + 1, period] = length
    return sorted((start, length, period) for (start, period), length in found.items())


def _windows(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Disjoint stretches outside which no run can lie; every run lies inside one of them.

    In a run of `m + q` words and period q each of the first m recurs within q words, and m >= (min_exponent - 1) * q. So a
    word whose next place is further away than the stretch around it allows cannot be among them, which narrows the
    stretches again and again. Narrowing only saves work: stopping early is as exact.
    """
    n, times = len(ids), min_exponent - 1
    least = -(-min_length * times // min_exponent)
    order = np.argsort(ids, kind="stable")
    gap = np.full(n, n + 1)
    same = ids[order[1:]] == ids[order[:-1]]
    gap[order[:-1][same]] = np.diff(order)[same]
    at, was = np.flatnonzero(gap * times <= n), n
    for _ in range(NARROWINGS):
        if not len(at) or len(at) == was:
            break
        was = len(at)
        first = np.concatenate([[0], np.flatnonzero(np.diff(at) != 1) + 1])
        sizes = np.diff(np.append(first, len(at)))
        room = np.repeat(sizes, sizes)
        at = at[(room >= least) & (gap[at] * times <= room)]
    if not len(at):
        return []
    first = np.concatenate([[0], np.flatnonzero(np.diff(at) != 1) + 1])
    last = np.append(first[1:], len(at)) - 1
    out: list[tuple[int, int]] = []
    for a, b in zip(at[first].tolist(), (at[last] + 1).tolist(), strict=True):
        stop = min(n, b + (b - a) // times)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((a, stop))
    return out


def text_runs(words: list[bytes], min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """The runs of a text's words, see `runs_of`."""
    if len(words) < min_length:
        return []
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, len(words))
    out = []
    for a, b in _windows(ids, min_length, min_exponent):
        word = np.unique(ids[a:b], return_inverse=True)[1].tolist()
        out += [(a + start, length, period) for start, length, period in runs_of(word, min_length, min_exponent)]
    return out


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period:start + length] = True
    return [words[i] for i in np.flatnonzero(~drop).tolist()]


def find_runs(texts: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 6,
              min_exponent: int = 4) -> DataFrame:
    """`key`, n_words, runs and collapsed of every row, in one pass without a shuffle.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text, numbered from 0. runs: array of (start, length, period), by start, then
    period: the stretches of at least `min_length` words and `min_exponent` (2 at least) times their smallest period that no
    neighbouring word extends. collapsed: the words that no run contains after its first period, joined by one space.
    A null or empty text has no words, no runs and an empty collapsed text. A null or repeated key is carried through, one
    result per input row; other columns of the input are left out.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent must be at least 2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                n_words, runs, collapsed = [], [], []
                for body in part.column("text").cast(pa.large_binary()).to_pylist():
                    words = (body or b"").split()
                    own = text_runs(words, min_length, min_exponent)
                    n_words.append(len(words))
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                    collapsed.append(b" ".join(_kept(words, own)))
                yield pa.RecordBatch.from_arrays([
                    part.column("key"), pa.array(n_words, pa.int64()), pa.array(runs, kind),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ], names=["key", "n_words", "runs", "collapsed"])

    kind_of_key = texts.schema[key].dataType.simpleString()
    return (texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind_of_key}, n_words long, runs {RUNS}, collapsed string")
            .select(F.col("key").alias(key), "n_words", "runs", "collapsed"))
