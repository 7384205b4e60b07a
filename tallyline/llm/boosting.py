"""Gradient boosting of small trees for two classes, on dense features.

Trees grow level by level from sums over all rows: gradients and weights by node, feature and bin. The sums are whole numbers, so
they are the same whether one array gives them or the tasks of a Spark job.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize

#: Gradients and weights are counted in these parts of one.
SCALE = 1 << 24
#: Distinct rows up to which a table is fitted in the driver; from there on by one Spark job a level, with the same result.
LOCAL_ROWS = 20_000


@dataclass(frozen=True)
class Tree:
    """Complete binary tree by levels: feature and threshold of inner nodes, then leaf values."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def node(self, x: np.ndarray, level: int) -> np.ndarray:
        """Which node of a level each row falls into, from 0."""
        node = np.zeros(len(x), int)
        for _ in range(level):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.threshold[node])
        return node - (2 ** level - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.node(x, len(self.value).bit_length() - 1)]


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Tree, ...]

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score += tree.predict(x)
        return 0.5 * (1 + np.tanh(0.5 * score))


#: (trees so far, the one that grows, its level) to the gradients and weights by node, feature and bin.
Count = Callable[[list[Tree], Tree, int], np.ndarray]


def _places(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of each value: how many cuts lie below it."""
    return np.stack([np.searchsorted(at, x[:, f], side="left") for f, at in enumerate(cuts)], axis=1).astype(np.uint8)


def _sums(place: np.ndarray, y: np.ndarray, n: np.ndarray, score: np.ndarray, node: np.ndarray, nodes: int, bins: int) -> np.ndarray:
    """The sums over rows that stand for `n` equal ones each."""
    p = 0.5 * (1 + np.tanh(0.5 * score))
    features = place.shape[1]
    cell = ((node[:, None] * features + np.arange(features)) * bins + place).ravel()
    return np.stack([np.bincount(cell, np.repeat(np.rint(part * SCALE) * n, features), nodes * features * bins)
                     for part in (y - p, p * (1 - p))]).astype(np.int64)


def _local_count(place: np.ndarray, y: np.ndarray, n: np.ndarray, start: float, bins: int) -> Count:
    score, known = np.full(len(y), start), [0]

    def count(trees: list[Tree], partial: Tree, level: int) -> np.ndarray:
        for tree in trees[known[0]:]:
            np.add(score, tree.predict(place), out=score)
        known[0] = len(trees)
        return _sums(place, y, n, score, partial.node(place, level), 2 ** level, bins)

    return count


def _spark_count(rows: DataFrame, features: int, start: float, bins: int) -> Count:
    """The same over a table (place, y, n): each task adds up its rows, and only the sums reach the driver."""

    def count(trees: list[Tree], partial: Tree, level: int) -> np.ndarray:
        nodes = 2 ** level

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, nodes * features * bins), np.int64)
            for batch in batches:
                place = np.frombuffer(b"".join(batch.column("place").to_pylist()), np.uint8).reshape(-1, features)
                score = np.full(len(place), start)
                for tree in trees:
                    score += tree.predict(place)
                total += _sums(place, batch.column("y").to_numpy(zero_copy_only=False), batch.column("n").to_numpy(), score,
                               partial.node(place, level), nodes, bins)
            cells = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), *map(pa.array, total[:, cells])],
                                             names=["cell", "gradient", "weight"])

        found = rows.mapInArrow(run, "cell int, gradient long, weight long").groupBy("cell").agg(
            F.sum("gradient").alias("gradient"), F.sum("weight").alias("weight")).toArrow()
        total = np.zeros((2, nodes * features * bins), np.int64)
        total[:, found.column("cell").to_numpy()] = [found.column(c).to_numpy() for c in ("gradient", "weight")]
        return total

    return count


def _boost(count: Count, start: float, cuts: list[np.ndarray], rounds: int, depth: int, rate: float, bins: int) -> Boosted:
    inner = 2 ** depth - 1
    trees, by_bin = [], []
    for _ in range(rounds):
        feature, cut, value = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(inner + 1)
        threshold = np.full(inner, np.inf)
        for level in range(depth):
            sums = count(by_bin, Tree(feature, cut, value), level).reshape(2, 2 ** level, len(cuts), bins) / SCALE
            for n in range(2 ** level):
                at, best = 2 ** level - 1 + n, 1e-6
                total_g, total_w = sums[:, n, 0].sum(axis=-1)
                left_g, left_w = total_g, total_w
                for f, own in enumerate(cuts):
                    if not len(own):
                        continue
                    g, w = sums[:, n, f].cumsum(axis=-1)[:, :len(own)]
                    gain = g ** 2 / (w + 1) + (total_g - g) ** 2 / (total_w - w + 1) - total_g ** 2 / (total_w + 1)
                    i = int(np.argmax(gain))
                    if gain[i] > best:
                        best, feature[at], cut[at], threshold[at] = gain[i], f, i, own[i]
                        left_g, left_w = g[i], w[i]
                if level == depth - 1:
                    value[2 * n] = rate * left_g / (left_w + 1)
                    value[2 * n + 1] = rate * (total_g - left_g) / (total_w - left_w + 1)
        by_bin.append(Tree(feature, cut, value))
        trees.append(Tree(feature, threshold, value))
    return Boosted(start, tuple(trees))


def _start(share: float) -> float:
    share = np.clip(share, 1e-3, 1 - 1e-3)
    return float(np.log(share / (1 - share)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32) -> Boosted:
    """Logistic loss, Newton steps, at most `bins` thresholds per feature. One class only gives its prior."""
    start = _start(y.mean() if len(y) else 0.0)
    if not len(y) or y.all() or not y.any():
        return Boosted(start, ())
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins), method="lower"))[:-1] for column in x.T]
    count = _local_count(_places(x, cuts), y, np.ones(len(y)), start, bins)
    return _boost(count, start, cuts, rounds, depth, rate, bins)


def _placed(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(cuts))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in _places(x, cuts)], pa.binary()), batch.column("y"),
                                              batch.column("n")], names=["place", "y", "n"])

    return run


def fit_table(rows: DataFrame, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32) -> Boosted:
    """`fit` on all rows of a table: x (array of as many numbers in each row), y (boolean), n (how many equal rows it stands for).

    Thresholds are exact quantiles. Spark counts the distinct values of each feature for them, so these should be few, as they
    are of lengths and counts.
    """
    total, positive, features = rows.agg(F.sum("n"), F.sum(F.when(F.col("y"), F.col("n")).otherwise(0)), F.max(F.size("x"))).first()
    start = _start((positive or 0) / max(total or 0, 1))
    if not positive or positive == total:
        return Boosted(start, ())
    shares = [float(s) for s in np.linspace(0, 1, bins)]
    found = rows.agg(*[F.percentile(F.col("x")[f], shares, F.col("n")).alias(f"f{f}") for f in range(features)]).first()
    cuts = [np.unique(values)[:-1] for values in found]
    placed = materialize(rows.select("x", "y", "n").mapInArrow(_placed(cuts), "place binary, y boolean, n long")
                         .groupBy("place", "y").agg(F.sum("n").alias("n")), "boosting-rows")
    if placed.count() > LOCAL_ROWS:
        count = _spark_count(placed, features, start, bins)
    else:
        table = placed.toArrow()
        place = np.frombuffer(b"".join(table.column("place").to_pylist()), np.uint8).reshape(-1, features)
        count = _local_count(place, table.column("y").to_numpy(), table.column("n").to_numpy(), start, bins)
    return _boost(count, start, cuts, rounds, depth, rate, bins)


def lowest_threshold(probability: np.ndarray, y: np.ndarray, precision: float, n: np.ndarray | None = None) -> float:
    """A threshold above which at least `precision` of the rows are positive, and as many rows as possible: midway to the
    next lower probability. Above 1 if there is none. With `n` an entry stands for that many rows, `y` of them positive."""
    order = np.argsort(-probability, kind="stable")
    p, right = probability[order], np.cumsum(y[order])
    rows = np.cumsum(np.ones(len(p)) if n is None else n[order])
    last = np.append(p[1:] != p[:-1], True) if len(p) else np.empty(0, bool)
    good = np.flatnonzero((right >= precision * rows) & last)
    if not len(good):
        return 2.0
    return float(p[good[-1]] + (p[good[-1] + 1] if good[-1] + 1 < len(p) else 0.0)) / 2
