"""op7: layouts, round trip, loss mask; the whole table is compared with its SQL in test_queries."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.shared import rows
from tallyline.llm import chat


def turns(spark, *records):
    df = spark.createDataFrame([(i, 0, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)],
                               "id long, seq long, record string")
    return chat.canonical_turns(df, "id", "seq", "record")


def test_layouts(spark):
    got = turns(
        spark, {"messages": [{"content": "hi", "role": "user"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]},
        {"response": "r", "prompt": "p"}, {"instruction": "i", "input": "n", "output": "o"}, {"output": "o", "instruction": "i"},
        {"role": None, "text": "t"}, {"prompt": 5, "completion": True}, {"messages": []}, {"other": 1}, "no json", None)
    assert rows(got, "id", "place", "layout", "role", "text") == sorted([
        (0, 0, "messages", "user", "hi"), (0, 1, "messages", "assistant", ""),
        (1, 0, "conversations", "user", "q"), (1, 1, "conversations", "assistant", "a"), (1, 2, "conversations", "tool", "t"),
        (2, 0, "prompt", "user", "p"), (2, 1, "prompt", "assistant", "r"),
        (3, 0, "instruction", "system", "i"), (3, 1, "instruction", "user", "n"), (3, 2, "instruction", "assistant", "o"),
        (4, 0, "task", "user", "i"), (4, 1, "task", "assistant", "o"), (5, 0, "turn", "", "t"),
        (6, 0, "completion", "user", "5"), (6, 1, "completion", "assistant", "true"),
        (7, None, None, None, None), (8, None, None, None, None), (9, None, None, None, None), (10, None, None, None, None),
    ], key=repr)


ODD = st.lists(st.sampled_from(["</s>", "[INST]", "[/INST]", "<s>", "\\", "<", "[", "a", "é", "😀", "\n", "$1", " "]), max_size=12).map("".join)


def test_texts_come_back(spark):
    seen = []

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "[x]<"]), ODD), min_size=1, max_size=4))
    def collect(conversation):
        seen.append(conversation)

    collect()
    data = [(i, n, 0, role, text, "x") for i, c in enumerate(seen) for n, (role, text) in enumerate(c)]
    df = spark.createDataFrame(data, "id long, seq long, place long, role string, text string, formatted string")
    out = chat.format_turns(df, "id", "seq")
    read = out.select("id", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("formatted"), F.col("loss")).alias("under"))
    for r in read.collect():
        assert [tuple(t) for t in r.turns] == [*seen[r.id]]
        assert r.under == "".join(t for role, t in seen[r.id] if role == "assistant")
        assert r.formatted.count("</s>") == len(seen[r.id])
        assert len(r.loss) == sum(role == "assistant" for role, _ in seen[r.id])


def test_ties_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, 0, "user", "b"), (1, 0, 0, "user", "a"), (1, 0, 0, "user", "a"), (1, None, 0, "user", "n"),
                                (2, 0, None, None, None), (None, 0, 0, "assistant", "x")],
                               "id long, seq long, place long, role string, text string")
    out = chat.format_turns(df, "id", "seq")
    assert rows(out.select("id", chat.read_turns(F.col("formatted")).alias("t")).select("id", "t.text"), "id", "text") == sorted(
        [(1, ["n", "a", "a", "b"]), (2, []), (None, ["x"])], key=repr)
    assert chat.format_turns(df.where("id = 9"), "id", "seq").count() == 0


def test_layouts_with_further_fields(spark):
    """Fields that no layout names, plain or nested, and values of several types leave the layout known."""
    got = turns(
        spark, {"messages": [{"role": "user", "content": "q", "name": "n", "x y": {"z": [1, 2]}}], "id": 5},
        {"prompt": "p", "response": None, "id": 1.5, "meta": {"a": [{"b": 1}], "c": {}}},
        {"messages": [{"role": "user", "content": 5}, {"role": "assistant", "content": "z", "tools": []}]},
        {"text": "t", "role": "r", "source": [{"a": 1}]}, {"instruction": "i", "output": "o", "input": "n", "id": 1},
        {"messages": [{"role": "user"}], "id": 1}, {"messages": "text", "id": 1})
    assert rows(got, "id", "layout", "role", "text") == sorted([
        (0, "messages", "user", "q"), (1, "prompt", "user", "p"), (1, "prompt", "assistant", ""),
        (2, "messages", "user", "5"), (2, "messages", "assistant", "z"), (3, "turn", "r", "t"),
        (4, "instruction", "system", "i"), (4, "instruction", "user", "n"), (4, "instruction", "assistant", "o"),
        (5, None, None, None), (6, None, None, None)], key=repr)


def test_long_conversation(spark):
    """Work in proportion to the turns: with spans cut from the start of the text, 16,000 turns took a minute."""
    n = 64_000
    said = spark.range(n).select(
        F.lit(1).alias("id"), F.col("id").alias("seq"), F.lit(0).alias("place"),
        F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"), F.concat(F.lit("é </s> "), "id").alias("text"))
    out = chat.format_turns(said, "id", "seq")
    row = out.select(chat.read_turns(F.col("formatted")).alias("turns"), "loss", "formatted",
                     chat.loss_text(F.col("formatted"), F.col("loss")).alias("under")).first()
    assert [t.text for t in row.turns] == [f"é </s> {i}" for i in range(n)]
    assert row.under == "".join(f"é </s> {i}" for i in range(1, n, 2))
    assert all(row.formatted[s.start:s.stop] == f"é <\\/s> {2 * i + 1}" for i, s in enumerate(row.loss))
