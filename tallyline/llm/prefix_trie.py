"""The trie of conversation prefixes, with subtree figures by the Euler-tour technique.

A prefix is known by the sum of digests of (place, role, text) over its turns, four sums of 32-bit pieces: sums can be taken over
ranges of rows, so a conversation of any length spans many tasks. Equal sums at one depth are one node. The tour has an arc that
enters each node and one that leaves it. Its arcs are ranked as a linked list: in each round every arc whose hash is larger than
that of both neighbours is spliced out, a third of the arcs, until few are left; then the rounds are taken back. With the arcs in order,
what a subtree holds is the difference of two prefix sums.
"""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.versions import number_rows
from tallyline.session import materialize, numbered

WORD = "[^\\x20\\x09-\\x0D]+"
SUMS = ["s1", "s2", "s3", "s4"]
PIECE = 8
#: Arcs that one task ranks at the end of the rounds, and ids that go into one piece of a digest's input.
FEW_ARCS, PIECE_IDS = 1 << 14, 1 << 12


class Trie(NamedTuple):
    """nodes: node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, words, saved_tokens. ends: node and conv_id of
    every conversation whose last turn it is."""

    nodes: DataFrame
    ends: DataFrame


def numbered_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """(`key`, place, turn_key, words): the turns of each conversation numbered 1, 2, 3… by (`order`, role, text), null order
    first, with a digest of role and text and the number of words. Null roles and texts are empty; rows with a null key are left out.
    """
    filled = turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"), F.col(order).alias("turn"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    placed = number_rows(filled, "conv_id", ["turn", "role", "text"], "place")
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return materialize(placed.select(F.col("conv_id").alias(key), F.col("place").cast("long").alias("place"), digest.alias("turn_key"),
                                     F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")), "turns")


def running_sums(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """`rows` with each of `columns` summed up inside `key` by `order`, this row included.

    A key's rows may span many tasks: rows are cut into ranges of (key, order), written once, and the sums inside a range get the
    totals of the key's earlier ranges added.
    """
    ranged = materialize(rows.repartitionByRange(key, order).withColumn("_part", F.spark_partition_id()), "running")
    totals = ranged.groupBy(F.col("_part").alias("_own"), F.col(key).alias("_key")).agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.partitionBy("_key").orderBy("_own").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_own", "_key", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in columns])
    inside = Window.partitionBy("_part", key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.select(*[c for c in ranged.columns if c not in columns], *[F.sum(c).over(inside).alias(c) for c in columns])
    joined = summed.join(before, (F.col("_part") == F.col("_own")) & (F.col(key) == F.col("_key")))
    return joined.select(*[(F.col(c) + F.col(f"_before_{c}")).alias(c) if c in columns else F.col(c) for c in rows.columns])


def _pieces(depth: Column, turn_key: Column) -> list[Column]:
    digest = F.sha2(F.concat_ws(":", depth.cast("string"), turn_key), 256)
    return [F.conv(F.substring(digest, 1 + PIECE * i, PIECE), 16, 10).cast("long") for i in range(len(SUMS))]


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, words, sums of the prefix, sums of the prefix before its last turn)."""
    own = [f"own_{s}" for s in SUMS]
    pieces = turns.select("conv_id", "depth", "words", *[p.alias(o) for p, o in zip(
        _pieces(F.col("depth"), F.col("turn_key")), own, strict=True)])
    summed = running_sums(pieces.select("*", *[F.col(o).alias(s) for o, s in zip(own, SUMS, strict=True)]),
                          "conv_id", "depth", SUMS)
    return materialize(summed.select("conv_id", "depth", "words", *SUMS,
                                     *[(F.col(s) - F.col(o)).alias(f"up_{s}") for o, s in zip(own, SUMS, strict=True)]), "prefixes")


def _tree(prefixes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, parent, parent_conv_id, conv_id, depth, n_convs, words, sums) of every node; the root has no parent."""
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), *[zero.alias(s) for s in SUMS], "conv_id", "n_convs", zero.alias("words"),
        *[F.lit(-1).cast("long").alias(f"up_{s}") for s in SUMS])
    inner = prefixes.groupBy("depth", *SUMS).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        *[F.max(f"up_{s}").alias(f"up_{s}") for s in SUMS])
    nodes = numbered(root.unionByName(inner), "trie-nodes", "node")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                         (F.col("depth") + 1).alias("_depth"), *[F.col(s).alias(f"_{s}") for s in SUMS])
    same = F.col("depth") == F.col("_depth")
    for s in SUMS:
        same = same & (F.col(f"up_{s}") == F.col(f"_{s}"))
    return materialize(nodes.join(above, same, "left").select(
        "node", "parent", "parent_conv_id", "conv_id", "depth", "n_convs", "words", *SUMS), "trie")


def _tour(tree: DataFrame, kids: DataFrame) -> DataFrame:
    """(id, next): the arcs, 2 * node to enter and 2 * node + 1 to leave. Children follow one another by `place`."""
    enter, leave = lambda c: F.col(c) * 2, lambda c: F.col(c) * 2 + 1
    first = kids.where("place = 1").select(F.col("parent").alias("_of"), F.col("node").alias("_first"))
    following = kids.select(F.col("parent").alias("_parent"), (F.col("place") - 1).alias("_place"), F.col("node").alias("_next"))
    siblings = kids.join(following, (F.col("parent") == F.col("_parent")) & (F.col("place") == F.col("_place")), "left")
    down = tree.join(first, F.col("node") == F.col("_of"), "left").select(
        enter("node").alias("id"), F.coalesce(enter("_first"), leave("node")).alias("next"))
    up = siblings.select(leave("node").alias("id"), F.coalesce(enter("_next"), leave("parent")).alias("next"))
    end = tree.where("parent is null").select(leave("node").alias("id"), F.lit(None).cast("long").alias("next"))
    return materialize(down.unionByName(up).unionByName(end), "tour")


def _rank_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    step: dict[int, tuple[int | None, int]] = {}
    for batch in batches:
        step.update(zip(batch.column("id").to_pylist(),
                        zip(batch.column("next").to_pylist(), batch.column("hops").to_pylist(), strict=True), strict=True))
    place: dict[int, int] = {}
    for head in step.keys() - {after for after, _ in step.values()}:
        at, arc = 0, head
        while arc is not None:
            place[arc] = at
            arc, hops = step[arc]
            at += hops
    yield pa.RecordBatch.from_arrays([pa.array(list(place), pa.int64()), pa.array(list(place.values()), pa.int64())],
                                     names=["id", "place"])


def list_ranks(links: DataFrame, few: int = FEW_ARCS) -> DataFrame:
    """(id, place) for a linked list `links` (id, next; next is null at the end): the number of steps from its head, from 0.

    Each round is one join over the links that are left, written to the shared folder; the number of rounds grows with the logarithm
    of the list. At most `few` links are ranked in one task. No neighbours go in one round, as an arc goes only if its hash is
    above that of the one before it and not below that of the next one.
    """
    left, rounds = links.select("id", "next", F.lit(1).cast("long").alias("hops")), []
    while left.count() > few:
        salt = F.lit(len(rounds))
        falls = F.coalesce(F.xxhash64("id", salt) >= F.xxhash64("next", salt), F.lit(False)) & F.col("next").isNotNull()
        before = left.where(~falls)
        after = left.where(falls).select(F.col("id").alias("_id"), F.col("next").alias("_next"), F.col("hops").alias("_hops"))
        met = F.col("id").isNotNull() & F.col("_id").isNotNull()
        joined = materialize(before.join(after, F.col("next") == F.col("_id"), "full").select(
            F.coalesce("id", "_id").alias("id"), F.when(F.col("_id").isNull(), F.col("next")).otherwise(F.col("_next")).alias("next"),
            (F.coalesce("hops", F.lit(0)) + F.coalesce("_hops", F.lit(0))).alias("hops"),
            F.when(met, F.col("_id")).alias("gone"), F.when(met, F.col("hops")).alias("gone_after")), "list-round")
        rounds.append(joined)
        left = joined.select("id", "next", "hops")
    ranks = materialize(left.repartition(1).mapInArrow(_rank_few, "id long, place long"), "list-ranks")
    for joined in reversed(rounds):
        gone = joined.where("gone is not null").select(F.col("id").alias("_base"), "gone", "gone_after")
        back = gone.join(ranks, F.col("_base") == F.col("id")).select(
            F.col("gone").alias("id"), (F.col("place") + F.col("gone_after")).alias("place"))
        ranks = ranks.unionByName(materialize(back, "list-ranks"))
    return ranks


def _below(tree: DataFrame, kids: DataFrame) -> DataFrame:
    """(node, n_children, n_leaves, saved_tokens) from prefix sums over the ranked tour."""
    counts = kids.groupBy(F.col("parent").alias("_of")).agg(F.count("*").alias("n_children"))
    own = materialize(tree.join(counts, F.col("node") == F.col("_of"), "left").select(
        "node", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-weights")
    ranks = list_ranks(_tour(tree, kids))
    arcs = ranks.join(own.select((F.col("node") * 2).alias("_arc"), "leaf", "saved"), F.col("id") == F.col("_arc"), "left").select(
        F.lit(0).alias("list"), "id", "place", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("leaf", "saved")],
        *[F.coalesce(c, F.lit(0)).alias(f"own_{c}") for c in ("leaf", "saved")])
    summed = running_sums(arcs, "list", "place", ["leaf", "saved"])
    leaving = F.col("id") % 2 == 1

    def held(column: str) -> Column:
        return F.sum(F.when(leaving, F.col(column)).otherwise(F.col(f"own_{column}") - F.col(column)))

    below = summed.groupBy(F.shiftright("id", 1).alias("_node")).agg(
        held("leaf").alias("n_leaves"), held("saved").alias("saved_tokens"))
    return own.join(below, F.col("node") == F.col("_node")).select("node", "n_children", "n_leaves", "saved_tokens")


def prefix_trie(turns: DataFrame, members: DataFrame) -> Trie:
    """The trie of all prefixes of conversations.

    turns: (conv_id, depth 1, 2, 3…, turn_key, words), as of `numbered_turns`; members: every conv_id once, also of conversations
    without turns. Each distinct sequence of the first d turns is a node, from the root without turns at depth 0; without
    members there is none. conv_id is the smallest member whose prefix it is, so (conv_id, depth) is a key; n_convs counts the members,
    n_children and n_leaves the children and the childless nodes of the subtree with its top, saved_tokens the words that the subtree's
    nodes would not hold again: the sum of (n_convs - 1) * words of the last turn. Null keys must be left out before.
    """
    prefixes = _prefixes(turns)
    tree = _tree(prefixes, members)
    kids = materialize(number_rows(tree.where("parent is not null").select("parent", "conv_id", "node"), "parent", ["conv_id"],
                                   "place"), "trie-children")
    below = _below(tree, kids).withColumnRenamed("node", "_node")
    nodes = tree.join(below, F.col("node") == F.col("_node")).select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "words", "saved_tokens")
    last = prefixes.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("depth").alias("_last"))
    ended = prefixes.join(last, (F.col("conv_id") == F.col("_conv")) & (F.col("depth") == F.col("_last"))).select(
        "conv_id", "depth", *SUMS)
    turnless = members.join(last, F.col("conv_id") == F.col("_conv"), "left_anti").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in ("depth", *SUMS)])
    ends = ended.unionByName(turnless).join(tree.select("node", "depth", *SUMS), ["depth", *SUMS]).select("node", "conv_id")
    return Trie(nodes, ends)


def joined_digests(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(`key`, sha256): lower-case SHA-256 of the decimal `value`s of each key in ascending order, joined by commas.

    Ranges of (key, value) turn their values into pieces of text first; a key's pieces then pass one task in order, and only the
    state of the digest is kept. The digest is a chain by its nature, so that last step cannot be divided.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, values, cut = None, [], []

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*cut, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["key", "first", "piece"])

        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if values and (k != of or len(values) == PIECE_IDS):
                    cut.append((of, values[0], ",".join(map(str, values))))
                    values = []
                of = k
                values.append(v)
            if cut:
                yield table()
                cut = []
        if values:
            cut.append((of, values[0], ",".join(map(str, values))))
            yield table()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, state, keys, out = None, None, [], []
        for batch in batches:
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if state is not None and k == of:
                    state.update(b"," + piece.encode())
                    continue
                if state is not None:
                    keys.append(of)
                    out.append(state.hexdigest())
                of, state = k, hashlib.sha256(piece.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out)], names=["key", "sha256"])
                keys, out = [], []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([of], pa.int64()), pa.array([state.hexdigest()])], names=["key", "sha256"])

    cut = (rows.select(F.col(key).alias("key"), F.col(value).alias("value")).repartitionByRange("key", "value")
           .sortWithinPartitions("key", "value").mapInArrow(pieces, "key long, first long, piece string"))
    return (cut.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key long, sha256 string")
            .select(F.col("key").alias(key), "sha256"))
