"""op12: the runs against a comparison of all words at all distances, collapsed texts, odd rows."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.shared import LONG, TEXTS, documents, empty, frame, rows
from tallyline.llm import periodic_runs
from tallyline.llm.queries import planted_runs


def brute(word, min_length=6, min_exponent=4):
    """Every stretch in which words `period` apart are equal; of the same stretch the smallest period counts."""
    n, out = len(word), {}
    for period in range(1, n // min_exponent + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and word[j] == word[j + period]:
                j += 1
            length = j + period - i
            if j > i and length >= max(min_length, min_exponent * period):
                out.setdefault((i, length), period)
            i = max(j, i + 1)
    return sorted((start, length, period) for (start, length), period in out.items())


WORDS = st.lists(st.integers(0, 2), max_size=40)


@settings(max_examples=800, deadline=None)
@given(WORDS, WORDS, st.integers(1, 9), WORDS, st.sampled_from([(6, 4), (2, 2), (4, 3), (9, 4), (1, 5)]))
def test_runs(before, unit, times, after, least):
    word = before + unit[:7] * times + after
    assert periodic_runs.runs_of(word, *least) == brute(word, *least)
    assert periodic_runs.text_runs([b"%d" % w for w in word], *least) == brute(word, *least)


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    unit = [0, 0, 0, 0, 0, 0, 0] + [rng.randrange(1, 50) for _ in range(200)]
    word = [rng.randrange(100) for _ in range(500)] + unit * 5 + unit[:30] + [rng.randrange(100) for _ in range(300)]
    got = periodic_runs.text_runs([b"%d" % w for w in word])
    assert got == brute(word)
    assert sum(period == 1 for *_, period in got) == 6 and max(period for *_, period in got) == 207


@pytest.mark.parametrize("unit", [[0], [0, 1], list(range(700)), [0] * 50 + [1]])
def test_long_repetitions(unit):
    word = unit * (60_000 // len(unit))
    got = periodic_runs.runs_of(word)
    assert (0, len(word), len(unit)) in got and len(got) == (1 if len(unit) < 51 or unit[1] else 1 + len(word) // 51)


def test_collapsed_text(spark):
    df = spark.createDataFrame([(1, "x  a b\ta b a b a b a y"), (2, " no no no no no no "), (3, "no runs here\n")], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.find_runs(df).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 9, 2)] and got[1].collapsed == "x a b y"
    assert [tuple(r) for r in got[2].runs] == [(0, 6, 1)] and got[2].collapsed == "no"
    assert got[3].runs == [] and got[3].collapsed == "no runs here" and got[3].n_words == 3


def test_planted_table(spark):
    got = {r.doc_id: r for r in periodic_runs.find_runs(planted_runs(documents(spark))).collect()}
    texts = {r.doc_id: r.text for r in planted_runs(documents(spark)).collect()}
    assert any(r.runs for r in got.values())
    for i, r in got.items():
        words = texts[i].encode().split()
        if len(words) < 2500:
            assert [tuple(x) for x in r.runs] == brute(words)


def test_odd_rows(spark):
    df = frame(spark)
    got = periodic_runs.find_runs(df)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"] and got.count() == df.count()
    expected = [(i, len((t or "").encode().split())) for i, t in enumerate(TEXTS)]
    expected += [expected[-1], (None, 9)]
    assert rows(got, "doc_id", "n_words") == sorted(expected, key=repr)
    assert rows(got.where("size(runs) > 0"), "doc_id")[0] == (TEXTS.index(LONG),)
    assert planted_runs(df).count() == df.count()
    assert periodic_runs.find_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError, match="min_exponent"):
        periodic_runs.find_runs(df, min_exponent=1)
