"""op13: the trie against one built with a dictionary, list ranks, digests of long lists, odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from llm.shared import SF_DIR, rows
from tallyline.llm import prefix_trie as T
from tallyline.llm.queries import QUERIES, rebuilt_turns

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def brute(conversations):
    """conversations: conv_id -> list of (role, text)."""
    nodes = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[:len(prefix)] == prefix]
        leaves = [p for p in below if not any(len(o) == len(p) + 1 and o[:len(p)] == p for o in nodes)]
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = sorted(c for c in members if len(conversations[c]) == len(prefix))
        out.append((min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members),
                    sum(len(o) == len(prefix) + 1 and o[:len(prefix)] == prefix for o in nodes), len(leaves), saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, conversations):
    data = [(c, i, role, text) for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(data)
    turns = T.numbered_turns(spark.createDataFrame(data, "conv_id long, turn int, role string, text string"))
    members = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    built = T.prefix_trie(turns.withColumnRenamed("place", "depth"), members)
    digests = T.joined_digests(built.ends, "node", "conv_id")
    whole = built.nodes.join(digests, "node", "left").withColumn("sha", F.coalesce("sha256", F.sha2(F.lit(""), 256)))
    return rows(whole, *COLUMNS, "sha")


@pytest.mark.parametrize("few", [60, 1 << 14])
def test_trie(spark, monkeypatch, few):
    monkeypatch.setattr(T, "FEW_ARCS", few)
    monkeypatch.setattr(T.list_ranks, "__defaults__", (few,))
    rng = random.Random(2)
    conversations = {c: [(rng.choice("ua"), " ".join(rng.choices("xy", k=rng.randrange(3)))) for _ in range(rng.randrange(4))]
                     for c in rng.sample(range(-50, 500), 70)}
    # One long conversation and one that goes on from it.
    conversations[1000] = [("u", f"turn {i} of many") for i in range(300)]
    conversations[1001] = [*conversations[1000][:250], ("a", "another end")]
    assert trie(spark, conversations) == brute(conversations)


def test_role_and_text_do_not_run_together(spark):
    conversations = {1: [("ab", "c")], 2: [("a", "bc")], 3: [("", "abc")], 4: [("ab", "c")]}
    assert trie(spark, conversations) == brute(conversations)


def test_a_common_first_turn_and_equal_conversations(spark):
    conversations = {c: [("u", "hello there"), *([("a", f"{c}")] if c % 3 else [])] for c in range(600)}
    assert trie(spark, conversations) == brute(conversations)


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_list_ranks(spark, n):
    order = random.Random(n).sample(range(10_000), n)
    links = spark.createDataFrame([*zip(order, [*order[1:], None])], "id long, next long")
    assert {r.id: r.place for r in T.list_ranks(links, few=2).collect()} == {x: i for i, x in enumerate(order)}


def test_running_sums(spark):
    rng = random.Random(4)
    data = [(rng.choice([1, 1, 1, 1, 2, 3]), i, rng.randrange(100)) for i in range(500)]
    rng.shuffle(data)
    got = {(r.k, r.at): r.x for r in T.running_sums(spark.createDataFrame(data, "k long, at long, x long"), "k", "at", ["x"]).collect()}
    assert got == {(k, at): sum(x for k2, at2, x in data if k2 == k and at2 <= at) for k, at, _ in data}


def test_digest_of_a_long_list(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE_IDS", 7)
    df = spark.range(0, 20_000).select((F.col("id") % 3 - 1).alias("k"), (F.col("id") * 7919 % 20_000 - 50).alias("v"))
    for r in T.joined_digests(df, "k", "v").collect():
        values = sorted(i * 7919 % 20_000 - 50 for i in range(20_000) if i % 3 - 1 == r.k)
        assert r.sha256 == hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()


def test_order_nulls_and_empty_tables(spark):
    data = [(1, 2, "u", "b", "x"), (1, None, "u", None, "x"), (1, 2, "u", "a", "x"), (1, 2, "u", "a", "x"), (None, 0, "u", "z", "x"), (2, 0, None, "q", None)]
    df = spark.createDataFrame(data, "conv_id long, turn int, role string, text string, depth string")
    got = T.numbered_turns(df)
    assert rows(got, "conv_id", "place", "words") == [(1, 1, 0), (1, 2, 1), (1, 3, 1), (1, 4, 1), (2, 1, 1)]
    keys = {(r.conv_id, r.place): r.turn_key for r in got.collect()}
    assert keys[1, 2] == keys[1, 3] != keys[1, 4]
    turns, members = rebuilt_turns(T.numbered_turns(df.where("conv_id = 9")))
    built = T.prefix_trie(turns, members)
    assert built.nodes.count() == built.ends.count() == 0


def test_members_without_turns(spark):
    none = spark.createDataFrame([], "conv_id long, depth long, turn_key string, words long")
    built = T.prefix_trie(none, spark.range(3).withColumnRenamed("id", "conv_id"))
    assert rows(built.nodes, *COLUMNS) == [(0, 0, None, 3, 0, 1, 0)] and built.ends.count() == 3


def test_query_has_one_root(spark):
    got = QUERIES["op13_prefix_trie"](spark, SF_DIR)
    assert got.where("parent_conv_id is null").count() == 1
