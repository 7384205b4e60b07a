"""op6: runs, levels and odd rows; the whole table is compared with its SQL in test_queries."""

from pyspark.sql import functions as F

from llm.shared import LOWER, empty, frame, rows
from tallyline.llm import line_dedup as L

WHITE = " \t\n\x0b\x0c\r"


def brute(texts):
    held = {}
    cut = [(i, (t or "").split("\n")) for i, t in texts]
    order = lambda i: -(1 << 63) if i is None else i
    for i, lines in cut:
        for key in {line.strip(WHITE).translate(LOWER) for line in lines}:
            if len(key) >= 20:
                held.setdefault(key, set()).add(order(i))
    last = {k: max(v) for k, v in held.items() if len(v) >= 3}
    out = []
    for i, lines in cut:
        kept = [x for x in lines if order(i) >= last.get(x.strip(WHITE).translate(LOWER), order(i))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_odd_rows(spark):
    line = "  Ärger über Öl, a LINE of text İ"
    texts = [f"{line}\nown {i}\n{line.upper() if i % 4 == 0 else line}\t\n" for i in range(9)] + [
        "short\nshort", None, "", "\n", "a line in two documents only\nx", "a line in two documents only", "K" * 30]
    df = frame(spark, texts)
    for batches, fanout in ((1, 2), (5, 2)):
        got = L.drop_repeated_lines(df, batches=batches, fanout=fanout)
        assert rows(got, "doc_id", "text", "n_lines", "n_dropped") == brute([(r.doc_id, r.text) for r in df.collect()])
        assert set(got.columns) == {*df.columns, "n_dropped"}
    assert L.drop_repeated_lines(empty(spark)).count() == 0


def test_rows_of_one_key(spark):
    """Two texts under one id are one document; each keeps or loses its own lines."""
    line, other = "a line that stands in many documents", "another line that is long enough"
    texts = [(1, f"x\n{line}\n{other}"), (1, f"{line}\n{line}\nown line of the second text"), (2, line), (2, f"{other}\n{line}"), (1, other)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(L.drop_repeated_lines(df), "doc_id", "text") == sorted(texts, key=repr)
    more = df.unionByName(spark.createDataFrame([(3, line)], "doc_id long, text string"))
    assert rows(L.drop_repeated_lines(more), "doc_id", "text") == [b[:2] for b in brute([*texts, (3, line)])]


def test_runs_merge_by_levels(spark):
    runs = L.LineRuns(spark, fanout=2, buckets=3)
    lines = spark.range(40).select((F.col("id") % 7).alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("id").alias("doc"))
    for b in range(5):
        batch = lines.where(F.col("doc") % 5 == b).drop("doc")
        new = rows(runs.unseen(batch), "h1")
        assert bool(new) == (b == 0) or b < 2
        runs.add(batch)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = runs._all(runs._names())
    assert held.count() == held.select("h1").distinct().count() == 7
    assert rows(runs.frequent(6), "h1") == [(h,) for h in range(5)] and runs.frequent(5).count() == 7
    runs.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name in runs.path]


def test_new_batches_are_merged_against_the_runs(spark):
    """The anti-join reads a run in its buckets, without a shuffle or a sort of it."""
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = L.LineRuns(spark, buckets=4)
        lines = spark.range(1000).select(F.xxhash64("id").alias("h1"), F.col("id").alias("h2"))
        runs.add(lines)
        plan = runs.unseen(lines.groupBy(*L.HASH).agg(F.count("*").alias("n")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        runs.close()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_a_document_of_many_repeated_lines(spark):
    """100,000 lines of which each is lost."""
    text = "\n".join([f"a repeated line of this text {i % 1000}" for i in range(100_000)])
    df = spark.createDataFrame([(i, f"{text}\nown {i}") for i in range(3)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.drop_repeated_lines(df).collect()}
    assert [got[i].n_dropped for i in range(3)] == [100_000, 100_000, 0] and got[0].text == "own 0" and got[2].n_lines == 100_001


def test_no_python_in_the_plan(spark):
    plan = L.drop_repeated_lines(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
