"""What a Python worker keeps: one object, and none once another operator works in it."""

import random

import public_tokenizers
from tallyline.llm import bpe, ngram_join, worker

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_one_object_is_kept():
    made = []
    assert [worker.kept(("a",), lambda: made.append(1) or len(made)) for _ in range(3)] == [1, 1, 1]
    assert worker.kept(("b",), lambda: "b") == "b" and worker.kept(("a",), lambda: 2) == 2
    worker.release()
    assert worker.kept(("a",), lambda: 3) == 3
    worker.release()


def test_the_join_releases_the_coder():
    coder = bpe.coder_for(WORDS)
    assert bpe.coder_for(WORDS) is coder
    assert list(ngram_join._class_rows(4)([])) == []
    assert bpe.coder_for(WORDS) is not coder
    worker.release()


def test_tables_of_pairs_stay_bounded(monkeypatch):
    random_ = random.Random(4)
    words = ["".join(random_.choice("abcdeéü'") for _ in range(random_.randint(1, 14))).encode() for _ in range(2000)]
    coder = bpe.coder_for(WORDS).words
    want = [coder.encode(w) for w in words]
    worker.release()
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 100)
    coder = bpe.coder_for(WORDS).words
    assert [coder.encode(w) for w in words] == want and len(coder.good) <= 101
    worker.release()
