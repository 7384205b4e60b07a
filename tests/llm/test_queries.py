"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as P
import public_tokenizers
from compare import duck_result, spark_result
from llm.shared import SF_DIR, documents, empty, frame, reordered
from tallyline.llm.queries import QUERIES, SQL
from llm.test_line_dedup import brute as brute_lines
from llm.test_ngram_join import brute as brute_groups


def test_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert spark_result(QUERIES[name](spark, SF_DIR)) == duck_result(SQL[name], SF_DIR)


def test_pipeline_stages(spark):
    docs = documents(spark)
    before = {r.doc_id: r.text for r in docs.collect()}
    calm = {r.doc_id: r.text for r in P.drop_toxic(spark, docs, SF_DIR).collect()}
    assert calm.items() <= before.items() and len(calm) > 0.8 * len(before)
    cut = P.drop_lines(spark, docs, SF_DIR)
    assert cut.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == [x[:2] for x in brute_lines([*before.items()])]
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    kept = {r.doc_id for r in P.drop_near_copies(spark, docs, SF_DIR).collect()}
    assert kept == {c if n else i for i, n, c in brute_groups([*before.items()], 5, 80)}
    clean = P.drop_leaks(spark, docs, SF_DIR)
    bad = {r.doc_id for r in QUERIES["op5_decontaminate"](spark, SF_DIR).collect()}
    assert bad and {r.doc_id for r in clean.collect()} == set(before) - bad
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    counts = {r.doc_id: r.n_tokens for r in P.encode(spark, docs, SF_DIR).collect()}
    assert counts == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in before.items()}


def test_stages_take_odd_rows(spark):
    for _, stage in P.STAGES[:-1]:
        df = frame(spark)
        assert stage(spark, df, SF_DIR).columns == df.columns
        assert stage(spark, empty(spark), SF_DIR).count() == 0


def test_leaks_of_an_input_in_another_order_on_each_scan(spark):
    docs = documents(spark)
    clean = P.drop_leaks(spark, reordered(docs), SF_DIR)
    bad = {r.doc_id for r in QUERIES["op5_decontaminate"](spark, SF_DIR).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad


def test_run(spark):
    ids = {r.doc_id for r in P.run(spark, SF_DIR).collect()}
    assert ids and ids < {r.doc_id for r in documents(spark).select("doc_id").collect()}
