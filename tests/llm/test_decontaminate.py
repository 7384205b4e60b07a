"""op5: planted passages and paraphrases are found, clean documents are not; odd rows."""

import random

import numpy as np

from llm.shared import documents, empty, frame, rows, SF_DIR
from tallyline.llm import decontaminate as D


def corpus(spark):
    random_ = random.Random(7)
    word = lambda: "".join(random_.choice(["ka", "lo", "mi", "ter", "un", "so", "vel", "pra"]) for _ in range(random_.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(random_.randint(25, 45))) + "? " + " ".join(word() for _ in range(4)) + ".")
             for i in range(12)] + [(98, None), (99, "")]
    docs, want = [], set()
    for i in range(150):
        own = [word() for _ in range(random_.randint(30, 300))]
        if i % 5 == 0:
            item, text = items[(i // 5) % 12]
            said = text.split()
            if i % 10 == 0:  # a paraphrase: some words replaced, the answer kept
                for at in range(2, len(said) - 5, 6):
                    said[at] = word()
            place = random_.randrange(len(own))
            own[place:place] = [w.upper() if i % 15 == 0 else w for w in said]
            want.add((i, item))
        docs.append((i, "\n".join(own), "x"))
    return (spark.createDataFrame(docs, "doc_id long, text string, item_id string"),
            spark.createDataFrame(items, "item_id long, text string"), want)


def test_planted_passages(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 5)
    docs, items, want = corpus(spark)
    got = {(r.doc_id, r.item_id) for r in D.contaminated_passages(docs, items).collect()}
    assert got == want


def test_short_and_changed_items(spark):
    """Items of all lengths as they are, and with a fifth of their words replaced, the rarest ones too."""
    random_ = random.Random(11)
    common = [f"c{i}" for i in range(60)]
    items, docs, want = [], [], set()
    for i in range(120):
        size = random_.choice([1, 2, 4, 6, 8, 12, 24, 40])
        said = [random_.choice(common) if k % 3 else f"rare{i}x{k}" for k in range(size)]
        items.append((i, " ".join(said)))
        copy = list(said)
        if size >= 10 and i % 2:
            for at in range(0, size // 5 * 3, 3):
                copy[at] = f"other{i}x{at}"
        own = [random_.choice(common) if random_.random() < 0.5 else f"own{i}x{k}" for k in range(200)]
        own[100:100] = copy
        docs.append((i, " ".join(own)))
        want.add((i, i))
    docs += [(1000 + i, " ".join(random_.choice(common) for _ in range(150))) for i in range(30)]
    got = D.contaminated_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                                  spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_whole_items_in_the_table(spark):
    docs, items = documents(spark), spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    flat = lambda t: " ".join(t.split())
    texts = [(r.doc_id, flat(r.text)) for r in docs.collect()]
    want = {(d, r.item_id) for r in items.collect() for d, t in texts if flat(r.text) in t}
    got = {(r.doc_id, r.item_id) for r in D.contaminated_passages(docs, items).collect()}
    assert want and want <= got


def test_common_subsequence():
    random_ = np.random.default_rng(0)
    for _ in range(100):
        a, b = (random_.integers(0, 6, n).astype(np.uint32) for n in random_.integers(1, 30, 2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        assert D.common_subsequence(a, b) == best[-1, -1]


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "same text here for all of us"), (2, None), (None, "one two three"), (3, "...")],
                                  "item_id long, text string")
    got = D.contaminated_passages(frame(spark), items)
    same = [(12, 1), (13, 1), (13, 1), (5, None)]
    assert rows(got, "doc_id", "item_id") == sorted(same, key=repr)
    assert D.contaminated_passages(empty(spark), items).count() == 0
    assert D.contaminated_passages(frame(spark), items.where("false")).count() == 0


def test_words_of_an_item_in_another_order(spark):
    """Long texts that use an item's words over and over, backwards or shuffled, hold no item."""
    random_ = random.Random(3)
    said = [f"word{i}" for i in range(30)]
    shuffled = [w for _ in range(40) for w in random_.sample(said, 30)]
    docs = [(1, " ".join(said[::-1] * 40)), (2, " ".join(shuffled)), (3, " ".join([*shuffled, *said, *shuffled]))]
    got = D.contaminated_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                                  spark.createDataFrame([(7, " ".join(said))], "item_id long, text string")).collect()
    assert {r.doc_id for r in got} == {3}
    assert any(r.first_word <= 1200 and r.last_word >= 1230 and r.share == 1 for r in got)
    assert all(r.last_word - r.first_word <= D.STRETCH * 30 for r in got)


def test_spans_equal_all_windows():
    """A region has a span exactly where one of its windows passes."""
    random_ = np.random.default_rng(5)
    for _ in range(200):
        item = random_.integers(0, 40, random_.integers(8, 30)).astype(np.uint32)
        region = random_.integers(0, 40, 300).astype(np.uint32)
        if random_.random() < 0.5:
            at = random_.integers(0, 250)
            region[at:at + len(item)] = item
        found = list(D.spans(item, item[:0], region, 0.8, 0.6))
        width = D.STRETCH * len(item)
        every = [D.common_subsequence(item, region[s:s + width]) / len(item) for s in range(len(region) - width + 1)]
        assert all(every[a] == share >= 0.8 and b - a == width for a, b, share, _ in found)
        whole = [s for s in range(len(region) - len(item)) if np.array_equal(region[s:s + len(item)], item)]
        assert all(any(a <= s and s + len(item) <= b for a, b, _, _ in found) for s in whole) or not whole


def test_recall_of_changed_items(spark):
    """Items of the table among its documents: as they are, a fifth replaced, a word after every word."""
    random_ = random.Random(9)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
             if r.text and len(r.text.split()) >= 12][:60]
    hosts = [r.text.split() for r in documents(spark).where("length(text) > 200").limit(60).collect()]
    docs, want = [], {}
    for n, (item, text) in enumerate(items):
        said, host = text.split(), hosts[n % len(hosts)]
        gone = set(random_.sample(range(len(said)), len(said) // 5))
        changed = {"whole": said, "inserted": [x for i, w in enumerate(said) for x in (w, f"new{n}x{i}")],
                   "replaced": [f"new{n}x{i}" if i in gone else w for i, w in enumerate(said)]}
        for k, (how, copy) in enumerate(changed.items()):
            docs.append((10 * n + k, " ".join([*host[:20], *copy, *host[20:]])))
            want.setdefault(how, set()).add((10 * n + k, item))
    got = {(r.doc_id, r.item_id) for r in D.contaminated_passages(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    share = {how: len(pairs & got) / len(pairs) for how, pairs in want.items()}
    print(share)
    assert share["whole"] == 1 and share["inserted"] >= 0.9 and share["replaced"] >= 0.9, share
