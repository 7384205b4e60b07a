"""op1 and op10 against the libraries themselves."""

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.shared import TEXTS, documents, empty, frame, rows
from tallyline.llm import bpe, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = st.text(st.sampled_from(list("abtheing E'sllrev ▁\n\té́É日ſßİKΣς½٣!_\x00\x1f\x85\xa0​😀")), max_size=40)

library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
tokenizer = Tokenizer.from_file(WORDS)


def expected_count(text):
    return len(library.encode(text or ""))


def test_counts_equal_the_library(spark):
    got = token_counts.count_tokens(documents(spark), PIECES, limit=1000)
    want = [(r.doc_id, len(r.text.encode()), n := expected_count(r.text), n > 1000) for r in documents(spark).collect()]
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_counts_of_odd_rows(spark):
    got = token_counts.count_tokens(frame(spark), PIECES, batch_bytes=1000)
    want = [(i, expected_count(t)) for i, t in enumerate(TEXTS)] + [(len(TEXTS) - 1, expected_count(TEXTS[-1]))]
    want.append((None, expected_count("a text without an id that is long enough")))
    assert rows(got, "doc_id", "n_tokens") == sorted(want, key=repr)
    assert token_counts.count_tokens(empty(spark), PIECES).count() == 0


def test_counts_with_a_tokenizers_file(spark):
    got = token_counts.count_tokens(documents(spark), WORDS)
    want = [(r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids)) for r in documents(spark).collect()]
    assert rows(got, "doc_id", "n_tokens") == sorted(want, key=repr)


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_segments_count_as_the_whole_text(text):
    assert token_counts.counter_for(PIECES, 1 << 20).count([text]) == [expected_count(text)]


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_any_text_encodes_as_in_the_library(text):
    coder = bpe.coder_for(WORDS)
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert coder.encode(text).tolist() == want
    assert coder.decode(want) == tokenizer.decode(want, skip_special_tokens=False)


def test_every_character_below_the_fast_limit():
    coder = bpe.coder_for(WORDS)
    for code in range(0x250):
        for text in (chr(code), f"{chr(code)}li", f"A{chr(code)}B", f"7 {chr(code)}{chr(code)}'s x"):
            assert coder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, (hex(code), text)


def test_long_words(spark):
    coder = bpe.coder_for(WORDS)
    for word in ("a" * 5000, "ing" * 3000, "thequickbrownfox" * 500):
        assert coder.encode(word).tolist() == tokenizer.encode(word, add_special_tokens=False).ids


def test_bpe_of_tables(spark):
    for df in (documents(spark), frame(spark)):
        got = bpe.encode(df, WORDS)
        want = []
        for r in df.collect():
            ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
            want.append((r.doc_id, ids, tokenizer.decode(ids, skip_special_tokens=False)))
        assert rows(got, "doc_id", "ids", "decoded") == sorted(want, key=repr)
    assert bpe.encode(empty(spark), WORDS).count() == 0
