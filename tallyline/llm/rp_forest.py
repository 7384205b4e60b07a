"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Inner product becomes nearness by one more coordinate, sqrt(M^2 - |x|^2), that gives all candidates the length M. The trees
are fitted on a bounded sample; every row is indexed in every tree. A query walks all trees through one priority queue,
nearest unvisited branch first, until it has its number of leaves: as many as held-out queries needed for nearly all of
their true neighbours among all rows. Leaf members are then ranked exactly.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.session import materialize

#: Rows the trees are fitted on at most: those with the smallest hashes of their id. All rows are indexed.
FIT_ROWS = 20_000
TREES = 20
LEAF_ROWS = 128
#: Leaves a query visits at least, over all trees, and the recall that held-out queries must reach with these or more.
PROBES = 320
RECALL = 0.95
#: Queries held out to find the number of leaves.
HELD = 100
#: Rows of the sample that give each query a floor: its k-th best score among them, which its k-th best of all reaches.
FLOOR_ROWS = 4096
#: Rows and queries that meet in one tile at most, about.
TILE_ROWS, TILE_QUERIES = 4096, 512


@dataclass(frozen=True)
class Tree:
    """Inner nodes by number: hyperplane and both children; a child under 0 is leaf -child - 1."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    root: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.full(len(x), self.root)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            side = np.einsum("ij,ij->i", x[inner], self.normals[at]) < self.offsets[at]
            node[inner] = self.children[at, side.astype(int)]
        return -node - 1


def build_tree(x: np.ndarray, leaf_rows: int, seed: int) -> Tree:
    """Split at the plane midway between two rows of the node, until a node has few rows or cannot be split."""
    random = np.random.default_rng(seed)
    normals, offsets, children = [], [], []
    leaves = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf_rows:
            for _ in range(8):
                a, b = x[random.choice(rows, 2, replace=False)]
                gap = a - b
                length = np.linalg.norm(gap)
                if not length:
                    continue
                normal = gap / length
                side = x[rows] @ normal
                offset = (a + b) @ normal / 2
                low = side < offset
                if 0.1 < low.mean() < 0.9:
                    break
            else:
                normal = None
            if normal is not None and 0 < low.sum() < len(rows):
                me = len(normals)
                normals.append(normal)
                offsets.append(offset)
                children.append([0, 0])
                children[me] = [grow(rows[~low]), grow(rows[low])]
                return me
        leaves += 1
        return -leaves

    root = grow(np.arange(len(x)))
    width = x.shape[1]
    return Tree(np.array(normals).reshape(-1, width), np.array(offsets), np.array(children, int).reshape(-1, 2), root)


def walk(forest: list[Tree], query: np.ndarray) -> Iterator[tuple[int, int]]:
    """(tree, leaf) of all leaves, nearest to the query first, over all trees through one queue."""
    sides = [t.normals @ query - t.offsets for t in forest]
    queue = [(0.0, i, t.root) for i, t in enumerate(forest)]
    heapq.heapify(queue)
    while queue:
        far, tree, node = heapq.heappop(queue)
        while node >= 0:
            side = sides[tree][node]
            near, other = forest[tree].children[node] if side >= 0 else forest[tree].children[node][::-1]
            heapq.heappush(queue, (max(far, abs(side)), tree, int(other)))
            node = int(near)
        yield tree, -node - 1


def search(forest: list[Tree], query: np.ndarray, probes: int) -> list[tuple[int, int]]:
    """(tree, leaf) of the leaves nearest to a query."""
    return list(islice(walk(forest, query), probes))


def direction(q: np.ndarray) -> np.ndarray:
    """A query as the trees see it."""
    return np.append(q / max(np.linalg.norm(q), 1e-300), 0.0)


def widened(x: np.ndarray, longest: float) -> np.ndarray:
    """Candidates as the trees see them, all of one length."""
    return np.column_stack([x, np.sqrt(np.maximum(longest ** 2 - (x ** 2).sum(axis=1), 0))])


def floors(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """A score that the k-th best of each query's candidates is known to reach; ids, x: some of the candidates."""
    if len(x) <= k:
        return np.full(len(queries), -np.inf)
    scores = queries @ x.T
    scores[own[:, None] == ids[None, :]] = -np.inf
    kth = np.partition(scores, len(x) - k, axis=1)[:, len(x) - k]
    return kth - 1e-9 * (1 + np.linalg.norm(queries, axis=1) * np.linalg.norm(x, axis=1).max())


def rank_tile(queries: np.ndarray, ids: np.ndarray, x: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
    """For each query the places of its k best rows from `floor` on, best first, ties to the smaller id, and their scores.

    ids must ascend. Products are added up in the order of the components, so that equal vectors have equal scores
    wherever they are ranked.
    """
    scores = np.zeros((len(queries), len(x)))
    for d in range(x.shape[1]):
        scores += np.multiply.outer(queries[:, d], x[:, d])
    for row, mine, low in zip(scores, own, floor, strict=True):
        open_ = np.flatnonzero((ids != mine) & (row >= low))
        if len(open_) > k:
            least = np.partition(row[open_], len(open_) - k)[len(open_) - k]
            open_ = open_[row[open_] >= least]
        best = open_[np.argsort(-row[open_], kind="stable")][:k]
        yield best, row[best]


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy().astype(np.float64)
    return values.reshape(len(column), -1)


def _index(forest, longest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"))
            wide = widened(x, longest)
            for i, tree in enumerate(trees):
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, i, np.int32)), pa.array(tree.leaves(wide).astype(np.int32)),
                     batch.column("id"), batch.column("v")], names=["tree", "leaf", "id", "v"])

    return run


def _probe(forest, some, probes: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, (some_ids, some_x) = forest.value, some.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, found, queries = [], [], _matrix(batch.column("v"))
            low = floors(queries, batch.column("id").to_numpy(), some_ids, some_x, k)
            for i, q in enumerate(queries):
                leaves = search(trees, direction(q), probes)
                rows += [i] * len(leaves)
                found += leaves
            picked = batch.take(pa.array(rows, pa.int64()))
            tree, leaf = np.array(found, np.int32).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree), pa.array(leaf), picked.column("id"), picked.column("v"), pa.array(low[rows])],
                names=["tree", "leaf", "id", "v", "floor"])

    return run


def _best_rows(held, k: int):
    """A partition's best rows for each held-out query, by exact scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = held.value
        best = [None] * len(own)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column("id").to_numpy(), _matrix(batch.column("v"))
            for i, score in enumerate(queries @ x.T):
                at = np.flatnonzero(ids != own[i])
                at = at[np.lexsort((ids[at], -score[at]))][:4 * k] if len(at) <= 4 * k else at[
                    np.argpartition(-score[at], 4 * k)[:4 * k]]
                rows = (ids[at], score[at], x[at])
                if best[i] is not None:
                    rows = tuple(np.concatenate(c) for c in zip(best[i], rows, strict=True))
                order = np.lexsort((rows[0], -rows[1]))
                order = order[np.sort(np.unique(rows[0][order], return_index=True)[1])][:k]
                best[i] = tuple(c[order] for c in rows)
        for i, rows in enumerate(best):
            if rows is not None:
                ends = np.arange(len(rows[0]) + 1, dtype=np.int32) * queries.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows[0]), i, np.int32)), pa.array(rows[0]), pa.array(rows[1]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(rows[2].ravel()))],
                    names=["query", "id", "score", "v"])

    return run


def _needed(forest, held, longest: float, k: int):
    """After how many leaves a held-out query has met each of its true neighbours."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        trees, ids, score = forest.value, table.column("id").to_numpy(), table.column("score").to_numpy()
        order = np.lexsort((ids, -score))
        order = order[np.sort(np.unique(ids[order], return_index=True)[1])][:k]
        wide = widened(_matrix(table.column("v").combine_chunks())[order], longest)
        lies: dict[tuple[int, int], list[int]] = {}
        for i, tree in enumerate(trees):
            for n, leaf in enumerate(tree.leaves(wide).tolist()):
                lies.setdefault((i, leaf), []).append(n)
        met: dict[int, int] = {}
        for leaves, place in enumerate(walk(trees, direction(held.value[1][key[0].as_py()])), 1):
            for n in lies.get(place, ()):
                met.setdefault(n, leaves)
            if len(met) == len(order):
                break
        return pa.table({"leaves": pa.array(list(met.values()), pa.int32())})

    return run


def probes_needed(rows: DataFrame, forest, longest: float, every: int, k: int, recall: float) -> int:
    """How many leaves held-out queries must visit in this forest until they have met the share `recall` of their `k` best
    among all rows. rows: (id, v). Queries of the largest hashes are held out, which the sample of the trees has last."""
    asked = rows.where(F.col("id") % every == 0).orderBy(F.xxhash64("id").desc(), "id").limit(HELD).toArrow()
    if not asked.num_rows:
        return 0
    held = rows.sparkSession.sparkContext.broadcast(
        (asked.column("id").to_numpy(), _matrix(asked.column("v").combine_chunks())))
    best = rows.mapInArrow(_best_rows(held, k), "query int, id long, score double, v array<double>")
    met = best.groupBy("query").applyInArrow(_needed(forest, held, longest, k), "leaves int").toArrow()
    leaves = np.sort(met.column("leaves").to_numpy())
    return int(leaves[int(np.ceil(recall * len(leaves))) - 1]) if len(leaves) else 0


def _tile(k: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        asked = table.column("asks").to_numpy().astype(bool)
        ids, x = table.column("id").to_numpy(), _matrix(table.column("v").combine_chunks())
        order = np.argsort(ids[~asked], kind="stable")
        row_ids, rows = ids[~asked][order], x[~asked][order]
        out = [[], [], []]
        if len(rows) and asked.any():
            low = table.column("floor").to_numpy()[asked]
            for q, (best, score) in zip(ids[asked], rank_tile(x[asked], row_ids, rows, ids[asked], low, k), strict=True):
                out[0].append(np.full(len(best), q))
                out[1].append(row_ids[best])
                out[2].append(score)
        q, v, s = (np.concatenate([np.empty(0), *c]) for c in out)
        return pa.table({"query_id": pa.array(q.astype(np.int64)), "vec_id": pa.array(v.astype(np.int64)),
                         "score": pa.array(s, pa.float64())})

    return run


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part: an id, and finite components of which one at least is not zero."""
    kind = vectors.schema[vector].dataType.simpleString()
    v = F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")
    good = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    real = F.coalesce(good & F.exists(v, lambda e: e != 0), F.lit(False))
    return vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & real)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, leaf_rows: int = LEAF_ROWS, probes: int | None = None,
            fit_rows_at_most: int = FIT_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, its `k` best other rows found.

    Best is the largest inner product in double precision, ties go to the smaller id; fewer rows than k give all.
    Rows with a null id or vector, a null or non-finite component or zeros only take no part, nor do vectors of another
    length than most have (of the longer length on a tie). Rows of one id count once for a query, with the best score; a
    query never finds its own id. An empty table gives no rows. Other columns are left out.

    A query visits `probes` leaves; if none are given, PROBES or as many as `probes_needed` finds for RECALL.
    The number of leaves grows with the rows up to what the sample can carry; leaves, whatever their size, are dealt
    in tiles of bounded rows and queries, so that many equal vectors or equal queries do not meet in one task.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    shapes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"),
                                                      F.max(F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))).alias("most"))
    shape = shapes.orderBy(F.col("rows").desc(), F.col("n").desc()).first()
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == shape.n)
    longest = float(np.sqrt(shape.most))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(fit_rows_at_most).select("id", "v").toArrow()
    x = _matrix(sample.column("v").combine_chunks())
    wide = widened(x, longest)
    in_sample = max(int(leaf_rows * len(x) / shape.rows), 8)
    forest = spark.sparkContext.broadcast([build_tree(wide, in_sample, seed) for seed in range(trees)])

    if probes is None:
        probes = max(PROBES, probes_needed(rows, forest, longest, every, k, RECALL))
    some = spark.sparkContext.broadcast((sample.column("id").to_numpy()[:FLOOR_ROWS], x[:FLOOR_ROWS]))
    kinds = f"tree int, leaf int, id long, v {rows.schema['v'].dataType.simpleString()}"
    index = rows.mapInArrow(_index(forest, longest), kinds)
    # Walking the trees costs much more than reading a row, so the queries are dealt to as many tasks as a shuffle has.
    asked = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "v"]).repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "id").mapInArrow(
        _probe(forest, some, probes, k), f"{kinds}, floor double")
    asked = materialize(asked, "forest-probes")

    def parts(side: DataFrame, most: int, name: str) -> DataFrame:
        """How many tiles each leaf's rows need; at most one row for each leaf of the forest."""
        return side.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / most).cast("int").alias(name))

    dealt = parts(index, TILE_ROWS, "row_parts").join(parts(asked, TILE_QUERIES, "query_parts"), ["tree", "leaf"])
    dealt = materialize(dealt, "forest-tiles")

    def tiles(side: DataFrame, mine: str, other: str, asks: int) -> DataFrame:
        own = F.pmod(F.xxhash64("id", F.lit(7)), F.col(f"{mine}_parts")).cast("int").alias(f"{mine}_part")
        every_other = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(f"{other}_part")
        split = side.join(dealt, ["tree", "leaf"]).select("*", own).select("*", every_other)
        return split.select("tree", "leaf", "row_part", "query_part", F.lit(asks).alias("asks"), "id", "v",
                            "floor" if asks else F.lit(None).cast("double").alias("floor"))

    met = tiles(index, "row", "query", 0).unionByName(tiles(asked, "query", "row", 1))
    found = met.groupBy("tree", "leaf", "row_part", "query_part").applyInArrow(
        _tile(k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
