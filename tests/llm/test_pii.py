"""op8: the rules against plain regular expressions, the trees on held-out rows, odd rows."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.shared import documents, empty, frame
from tallyline.llm import boosting, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in ((2, CARD, 12, 19), (3, PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from(list("0123456789.@+- ()aZé,%_")), max_size=40)
       | st.lists(st.sampled_from(["4111 1111 1111 1111", "+49 30 1234567", "a@b.c", "300.1.1.1", "0001.2.3.4", ".", "@", " ", "-", "7"]),
                  max_size=8).map("".join))
def test_rules(text):
    assert pii.base_spans(text) == brute(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_trees_on_held_out_rows():
    random = np.random.default_rng(1)
    x = random.normal(size=(1200, 5))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    p = boosting.fit(x[:800], y[:800]).probability(x[800:])
    assert ((p > 0.5) == y[800:]).mean() > 0.95
    cut = boosting.lowest_threshold(p, y[800:], 0.9)
    assert y[800:][p >= cut].mean() >= 0.9
    assert boosting.fit(x[:5], np.ones(5)).trees == () and boosting.lowest_threshold(p, np.zeros(400), 0.9) == 2.0


def test_tables(spark):
    for df in (documents(spark), frame(spark, [None, "", "x@y.org é +49 30 1234567", "é" * 50_000 + " 1.2.3.4", "4111-1111-1111-1111"])):
        model = pii.fit(df)
        got = pii.personal_data(df, model).collect()
        assert len(got) == df.count()
        found = sorted((repr(r.doc_id), [(s.start, pii.KINDS.index(s.kind), s.stop) for s in r.spans if s.base]) for r in got)
        assert found == sorted((repr(r.doc_id), brute(r.text or "")) for r in df.collect())
    assert pii.personal_data(empty(spark), pii.fit(empty(spark))).count() == 0


def test_added_spans_and_redaction(spark):
    """Where a loose format is as sure as a rule's, it is added; base spans stay."""
    always = boosting.Boosted(20.0, ())
    model = pii.PiiModel(always, (0.5,) * 4)
    df = spark.createDataFrame([(1, "write to bob [at] site [dot] org or eve@site.org, card 1234 5678 9012 3456")], "doc_id long, text string")
    row = pii.personal_data(df, model).first()
    assert row.redacted == "write to [email] or [email], card [card]"
    assert [(s.kind, s.base) for s in row.spans] == [("email", False), ("email", True), ("card", False)]


def planted(n, seed):
    """Texts with a rule's spans, numbers that are no personal data, and the same kinds of data in forms the rules miss."""
    random_ = random.Random(seed)
    word = lambda: "".join(random_.choice("abdeilmnorstu") for _ in range(random_.randint(3, 8)))

    def card():
        body = "4" + "".join(random_.choice("0123456789") for _ in range(14))
        return next(body + d for d in "0123456789" if pii.luhn(body + d))

    texts, want = [], []
    for i in range(n):
        own = [word() for _ in range(30)]
        spans = [f"{word()}@{word()}.org", ".".join(str(random_.randint(1, 255)) for _ in range(4)), card(),
                 f"+{random_.randint(1, 99)} ({random_.randint(200, 999)}) 555-{random_.randint(1000, 9999)}"]
        kind = i % 4
        number = card()
        own.insert(25, number[:-1] + str((int(number[-1]) + 3) % 10))
        held = i % 3 == 0
        span = pii.disguised(spans[kind], kind, i) if held else spans[kind]
        own.insert(10, span)
        texts.append((i, " ".join(own)))
        if held:
            at = len(" ".join(own[:10])) + 1
            want.append((i, pii.KINDS[kind], at, at + len(span)))
    return texts, want


def test_forms_that_the_rules_miss(spark):
    """Fitted on texts with rules' spans only, the trees find rewritten ones in other texts, and nearly nothing else."""
    texts, _ = planted(1500, 1)
    model = pii.fit(spark.createDataFrame([(i, t) for i, t in texts if i % 3], "doc_id long, text string"))
    texts, want = planted(900, 2)
    got = {(r.doc_id, s.kind, s.start, s.stop) for r in pii.personal_data(
        spark.createDataFrame(texts, "doc_id long, text string"), model).collect() for s in r.spans if not s.base}
    assert len(got & set(want)) >= 0.9 * len(want)
    assert len(got & set(want)) >= 0.95 * len(got)


def test_numbers_run_together():
    """A phone number before a card number: the rules take both for one number that is too long."""
    text = "call +1 (269) 555-3296 4524132264652876 now"
    assert pii.base_spans(text) == []
    assert {(5, 3, 22), (23, 2, 39)} <= set(pii.candidates(text))


def test_tables_are_fitted_alike_in_the_driver_and_on_spark(spark, monkeypatch):
    random_ = np.random.default_rng(5)
    x = random_.integers(0, 40, (3000, 4))
    y = (x[:, 0] > 12) & (x[:, 2] < 30) | (x[:, 3] == 7)
    rows = spark.createDataFrame([(r.tolist(), bool(t), 1 + i % 3) for i, (r, t) in enumerate(zip(x, y, strict=True))],
                                 "x array<int>, y boolean, n long")
    here = boosting.fit_table(rows, rounds=3)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
    there = boosting.fit_table(rows, rounds=3)
    assert (here.probability(x) == there.probability(x)).all()
    assert ((here.probability(x) > 0.5) == y).mean() > 0.9


def test_every_candidate_counts(spark, monkeypatch):
    """More candidates than any sample of 20,000: all held-out ones reach the thresholds, all others the trees."""
    texts = [" and ".join(f"{(i * 4 + k) * 7919 % 10**8 + 10**13:015d}" for k in range(4)) + " 10.0.0.1" for i in range(6000)]
    all_rows = [(t, r) for t in texts for r in pii.labelled(t, pii.base_spans(t))]
    held = sum(pii.zlib.crc32(t.encode()) % pii.HELD_OUT == 0 for t, r in all_rows if r[3])
    seen, real = [], boosting.lowest_threshold
    monkeypatch.setattr(boosting, "lowest_threshold", lambda p, y, precision, n: seen.append(n.sum() - 1) or real(p, y, precision, n))
    fitted = []
    real_fit = boosting.fit_table
    monkeypatch.setattr(boosting, "fit_table", lambda rows: fitted.append(rows.groupBy().sum("n").first()[0]) or real_fit(rows, rounds=2))
    pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert len(all_rows) > 20_000 and sum(seen) == held
    assert fitted == [sum(pii.zlib.crc32(t.encode()) % pii.HELD_OUT != 0 for t, _ in all_rows)]
