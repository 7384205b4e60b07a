"""op11: the automaton against plain recursion over the parts of a template, real wording, odd rows."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.shared import TEXTS, empty, frame, rows
from tallyline.llm import licenses as L


def ends(parts, words, at):
    """Every place where a match of `parts` from word `at` on may end."""
    if not parts:
        return {at}
    first, rest = parts[0], parts[1:]
    if isinstance(first, L.Region):
        return ends(rest, words, at) | {e for m in ends(first.parts, words, at) for e in ends(rest, words, m)}
    if isinstance(first, L.Gap):
        return {e for n in range(first.least, first.most + 1) if at + n <= len(words) for e in ends(rest, words, at + n)}
    return ends(rest, words, at + 1) if at < len(words) and words[at] == first else set()


def brute(text, templates, phrases):
    words = [w.encode() for w in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate({c: c + 32 for c in range(65, 91)}))]
    out = set()
    for base, items in ((True, phrases), (False, templates)):
        for label, template in items:
            free = 0
            for start in range(len(words)):
                found = ends(L.parse(template), words, start)
                if found and (base or start >= free):
                    free = max(found)
                    out.add((label, base, start, free))
    return len(words), sorted(out, key=lambda m: (m[2], m[3], not m[1], m[0]))


PHRASES = (("p", "a b"), ("q", "b a"))
TEMPLATES = (
    ("t", "a <<beginOptional>>b<<endOptional>> c"), ("u", 'a <<var;name="x";words="1-3">> c <<beginOptional>>d <<var;words="0-2">> d<<endOptional>>'),
    ("t", "<<beginOptional>>d <<beginOptional>>a<<endOptional>> b<<endOptional>> c a"), ("v", 'b <<var;words="2-2">> <<beginOptional>>b<<endOptional>> d'))


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "d", "A", "x", "É"]), max_size=25).map(" ".join))
def test_matches(text):
    assert L.Scanner(TEMPLATES, PHRASES).scan(text.encode()) == brute(text, TEMPLATES, PHRASES)


def test_forgetting_states_changes_nothing(monkeypatch):
    monkeypatch.setattr(L, "KEPT_STATES", 2)
    scanner, text = L.Scanner(TEMPLATES, PHRASES), "a x b c d a d a b c a b c d b b d" * 3
    assert scanner.scan(text.encode()) == brute(text, TEMPLATES, PHRASES)


WORDINGS = [
    ("Released under the MIT License.", "mit", "mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl", "gpl,gpl-3.0"),
    ("Licensed under the Apache License, Version 2.0.", "apache", "apache,apache-2.0"),
    ("Licensed under CC BY-NC 4.0.", "", "cc-by-nc-4.0"),
    ("Licensed under the Apache License, Version 1.1.", "apache", "apache"),
    ("under some MIT\n License", "mit", "mit"),
    ("This program is licensed under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 or later",
     "gpl", "gpl,gpl-3.0"),
    ("the mit licenses", "", ""),
]


def test_wording(spark):
    df = spark.createDataFrame([(i, f"Some text. {t} More text.") for i, (t, *_) in enumerate(WORDINGS)], "doc_id long, text string")
    for r in L.scan_licenses(df).collect():
        text, base, labels = WORDINGS[r.doc_id]
        assert ",".join(sorted({m.label for m in r.matches if m.base})) == base, text
        assert ",".join(sorted({m.label for m in r.matches})) == labels, text


def test_every_template_accepts_its_own_wording():
    scanner = L.Scanner(L.TEMPLATES, L.PHRASES)
    for label, template in L.TEMPLATES:
        full = re.sub(r"<<var[^>]*>>", " somebody ", template).replace("<<beginOptional>>", " ").replace("<<endOptional>>", " ")
        bare = template
        while "<<beginOptional>>" in bare:
            bare = re.sub(r"<<beginOptional>>((?!<<beginOptional>>).)*?<<endOptional>>", " ", bare)
        bare = re.sub(r"<<var[^>]*>>", " somebody ", bare)
        for text in (full, bare):
            assert label in {m[0] for m in scanner.scan(text.encode())[1] if not m[1]}, (label, text)
        words = L.words_of(bare.encode())
        for i in range(0, len(words), 7):
            changed = b" ".join([*words[:i], b"otherwise", *words[i + 1:]])
            if words[i] != b"somebody":
                assert label not in {m[0] for m in scanner.scan(changed)[1] if not m[1]}, (label, words[i])


@pytest.mark.parametrize("wrong", ["<<beginOptional>>a", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>", "", '<<var;words="0-3">>',
                                   'a <<var;words="3-1">>'])
def test_wrong_templates(spark, wrong):
    with pytest.raises(ValueError):
        L.scan_licenses(frame(spark), templates=(("x", wrong),))


def test_odd_rows(spark):
    df = frame(spark)
    got = L.scan_licenses(df)
    assert got.columns == ["doc_id", "n_words", "matches"]
    expected = [(i, brute(t or "", (), ())[0]) for i, t in enumerate(TEXTS)]
    assert rows(got, "doc_id", "n_words") == sorted([*expected, expected[-1], (None, 9)], key=repr)
    assert L.scan_licenses(empty(spark)).count() == 0
