"""op3: the regression on planted severities, and odd rows."""

import numpy as np

from llm.shared import empty, frame, rows
from tallyline.llm import toxicity


def corpus(spark, n, start=0):
    random = np.random.default_rng(start)
    vocabulary = [f"word{i}" for i in range(300)]
    out = []
    for i in range(n):
        own = list(random.choice(vocabulary, 60))
        grade = int(random.integers(0, 3)) if i % 3 == 0 else 0
        own += ["rude", "nasty"][:grade and 1] + ["vile", "vicious"] * (grade > 1)
        out.append((start + i, " ".join(random.permutation(own)).title(), grade))
    return spark.createDataFrame(out, "doc_id long, text string, grade int")


def test_held_out_grades(spark):
    train, test = corpus(spark, 900), corpus(spark, 300, 5000)
    model = toxicity.fit(train.drop("grade"), train.select("doc_id", "grade"))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    got = toxicity.score(test, model).collect()
    assert np.mean([r.rejected == (r.grade > 0) for r in got]) > 0.98
    means = [np.mean([r.severity for r in got if r.grade == g]) for g in range(3)]
    assert means[0] < 0.2 < means[1] < means[2]


def test_words_of_one_stem(spark):
    rows_ = [(i, f"gut tag haus{i} " + (f"gemein{i % 40}wort" if i % 4 == 0 else f"lieb{i % 40}wort"), int(i % 4 == 0))
             for i in range(400)]
    train = spark.createDataFrame(rows_, "doc_id long, text string, grade int")
    model = toxicity.fit(train, train.select("doc_id", "grade"))
    new = spark.createDataFrame([(1, "tag gemeinXYZ", "a"), (2, "tag liebXYZ", "b")], "doc_id long, text string, severity string")
    assert rows(toxicity.score(new, model), "doc_id", "rejected") == [(1, True), (2, False)]


def test_odd_rows(spark):
    train = corpus(spark, 300)
    labels = spark.createDataFrame([(0, 2), (0, None), (None, 1), (3, 1), (99999, 2)], "doc_id long, grade int")
    model = toxicity.fit(train.drop("grade"), labels)
    df = frame(spark)
    got = toxicity.score(df, model)
    assert got.count() == df.count() and set(got.columns) == set(df.columns)
    assert toxicity.score(empty(spark), model).count() == 0
    none = toxicity.fit(empty(spark), labels)
    assert len(none.words) == 0 and not any(r.rejected for r in toxicity.score(df, none).collect())
