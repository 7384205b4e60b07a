"""op4 against all pairs, and its bounds."""

import random

import numpy as np
import pyarrow as pa
import pytest

from llm.shared import documents, empty, frame, reordered, rows, words
from tallyline.llm import ngram_join as N
from tallyline.llm.components import components


def brute(texts, width, percent):
    sets = {}
    for i, t in texts:
        w = words(t)
        sets.setdefault(i, []).append({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    at = {i: i for i in sets}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    flat = [(i, s) for i, own in sets.items() for s in own if s]
    for a, (i, s) in enumerate(flat):
        for j, t in flat[:a]:
            both = len(s & t)
            if i != j and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((root(i), root(j)))
                at[y] = x
    return sorted(((i, len(s), root(i)) for i, own in sets.items() for s in own), key=repr)


def varied(seed):
    random_ = random.Random(seed)
    base = [[f"w{random_.randint(0, 400)}" for _ in range(random_.randint(1, 90))] for _ in range(12)]
    passage = [f"p{i}" for i in range(40)]
    out = []
    for i in range(130):
        own = list(random_.choice(base))
        for _ in range(random_.randint(0, 3)):
            own[random_.randrange(len(own))] = f"x{random_.randint(0, 50)}"
        out.append((i, " ".join(passage + own if random_.random() < 0.3 else own)))
    return out


@pytest.mark.parametrize(("width", "percent", "stars", "block"), [(4, 85, 3, 1024), (5, 80, 1, 4)])
def test_equals_all_pairs(spark, monkeypatch, width, percent, stars, block):
    """With one star and blocks of four most links come from tiles."""
    monkeypatch.setattr(N, "STARS", stars)
    monkeypatch.setattr(N, "BLOCK", block)
    texts = varied(width)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = N.ngram_components(df, width=width, percent=percent)
    assert rows(got, "doc_id", "n_shingles", "component_id") == brute(texts, width, percent)


def test_documents(spark):
    got = N.ngram_components(documents(spark), width=4, percent=85)
    assert rows(got, "doc_id", "n_shingles", "component_id") == brute([(r.doc_id, r.text) for r in documents(spark).collect()], 4, 85)


def test_small_entries_miss_no_pair(spark):
    """Groups of three and four texts under the same n-grams, in which only some pairs link, whatever the ids hash to."""
    passage = " ".join(f"p{i}" for i in range(30))
    texts = []
    for g in range(160):
        own = [f"g{g}w{i}" for i in range(40)]
        texts += [" ".join([*own[:-1], "a"]), f"{' '.join(own)} {passage} a", " ".join([*own[:-1], "b"])]
        if g % 2:
            texts.append(f"{' '.join(own)} {passage} b")
    texts = list(enumerate(texts))
    got = N.ngram_components(spark.createDataFrame(texts, "doc_id long, text string"), width=4, percent=85)
    assert rows(got, "doc_id", "n_shingles", "component_id") == brute(texts, 4, 85)


def test_input_in_another_order_on_each_scan(spark):
    texts = varied(5)
    df = reordered(spark.createDataFrame(texts, "doc_id long, text string"))
    want = brute(texts, 5, 80)
    assert rows(N.ngram_components(df), "doc_id", "n_shingles", "component_id") == want
    assert sorted(r.doc_id for r in N.one_of_each_group(df).collect()) == sorted({c if n else i for i, n, c in want})


def test_odd_rows(spark):
    df = frame(spark)
    got = rows(N.ngram_components(df), "doc_id", "n_shingles", "component_id")
    texts = [(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None]
    assert [r for r in got if r[0] is not None] == brute(texts, 5, 80)
    assert [r[2] for r in got if r[0] is None] == [None]
    kept = N.one_of_each_group(df)
    assert kept.columns == df.columns and kept.where("text like 'same text%'").count() == 1
    assert kept.where("doc_id is null").count() == 1
    assert N.ngram_components(empty(spark)).count() == 0 and N.one_of_each_group(empty(spark)).count() == 0


def test_bitmaps_bound_the_overlap():
    random_ = np.random.default_rng(3)
    for _ in range(200):
        a, b = (np.unique(random_.integers(0, 900, n).astype(np.uint64)) for n in random_.integers(1, 800, 2))
        both = N.fold([N.bitmap(a), N.bitmap(b)])
        most = N.bound_overlap(np.array([len(a)]), both[:1], np.array([len(b)]), both[1:])[0]
        assert len(np.intersect1d(a, b)) <= most <= min(len(a), len(b))


def test_components_of_a_path(spark):
    order = random.Random(1).sample(range(60), 60)
    df = spark.createDataFrame([*zip(order, order[1:]), (100, 101), (101, 101), (None, 5)], "u long, v long")
    assert rows(components(df), "node", "component") == sorted([*((i, 0) for i in range(60)), (100, 100), (101, 100)], key=repr)


def test_words_that_differ_only_in_order_of_letters(spark):
    """The two Thue-Morse words over a and b are one word to polynomials modulo 2^64, whatever their base."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    df = spark.createDataFrame([(1, one), (2, other), (3, one.upper())], "doc_id long, text string")
    assert rows(N.ngram_components(df), "doc_id", "n_shingles", "component_id") == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]


def test_one_partner_then_the_unconnected(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (4, 5)], "u long, v long")
    first = {tuple(r) for r in N.one_partner(pairs).collect()}
    assert len(first) <= 3 and {x for p in first for x in p} == {1, 2, 3, 4, 5}
    known = spark.createDataFrame([(1, 1), (2, 1)], "node long, component long")
    assert rows(N.unconnected(pairs, known), "u", "v") == [(1, 3), (2, 3), (4, 5)]


def test_a_tile_of_small_and_large_sets():
    """Unlike large sets stay apart beside a small one, whose bitmap is short; like ones are admitted."""
    random_ = np.random.default_rng(8)
    large = [random_.integers(0, 2**63, 3000).astype(np.uint64) for _ in range(20)]
    sets = [np.arange(5, dtype=np.uint64), *large, np.concatenate([large[0][:2900], large[1][:100]])]
    table = pa.table({"side": np.zeros(len(sets), np.int32), "doc": np.arange(len(sets)),
                      "size": np.array([len(s) for s in sets], np.int32), "component": np.arange(len(sets)),
                      "bits": pa.array([N.bitmap(s) for s in sets], pa.binary())})
    key = tuple(pa.scalar(x) for x in (0, 0, 0))
    assert N._tile(85)(key, table).to_pylist() == [{"u": 1, "v": 21}]


def test_bitmaps_are_shuffled_once_for_each_join(spark, monkeypatch):
    """No table but that of the rows carries bitmaps, and index entries are shuffled without their texts' other n-grams."""
    tables, real = {}, N.materialize

    def told(df, name, *rest):
        tables.setdefault(name, []).append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, name, *rest)

    monkeypatch.setattr(N, "materialize", told)
    monkeypatch.setattr(N, "STARS", 1)
    texts = varied(4)
    got = N.ngram_components(spark.createDataFrame(texts, "doc_id long, text string"), width=4, percent=85)
    assert rows(got, "doc_id", "n_shingles", "component_id") == brute(texts, 4, 85)
    assert [name for name, made in tables.items() if "bits" in made[0][0]] == ["ngram-rows"]
    _, plan = tables["ngram-entries"][0]
    assert "Join" in plan and plan.rindex("Generate explode") > plan.rindex("Join")
