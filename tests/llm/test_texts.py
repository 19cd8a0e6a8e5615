"""Language identification, I-Match fingerprints, and the pipeline."""

import hashlib
import zlib

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from payfeed.llm import imatch, language
from payfeed.llm.queries import QUERIES


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op6_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_texts_without_letters_are_unknown(spark):
    rows = [Row(i, t, la, "x", "y") for i, (t, la) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "en"), ("", "fr"), ("12 !? 34", None), ("the dog", None), ("the dog", None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score string")
    model = language.train(docs)
    assert sorted(set(model.languages)) == ["en", "fr"]
    got = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in language.predict(docs, model, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    for i in (2, 3, 4):
        assert got[i] == ("und", 0.0, True)
    assert got[5][0] == "en" and got[1][0] == "fr" and not got[0][2]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language.train(docs)
    assert language.predict(docs, model, ["doc_id"]).first().lang_pred == "und"
    assert language.predict(docs.limit(0), model, ["doc_id"]).count() == 0


def test_far_texts_are_rejected(spark):
    docs = spark.createDataFrame([(i, f"the cat number {'abcdefgh'[i % 8]} and the dog", "en") for i in range(40)], "doc_id long, text string, lang string")
    model = language.train(docs)
    odd = spark.createDataFrame([(1, "ЖЖ ЩЩ ФФ ЯЯ ЮЮ"), (2, "the cat and the dog")], "doc_id long, text string")
    got = {r.doc_id: r.rejected for r in language.predict(odd, model, ["doc_id"]).collect()}
    assert got == {1: True, 2: False}


def fingerprint_rows(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, fingerprint string")
    return imatch.compare_with_edits(docs)


def test_edited_texts_and_neighbours(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    order = sorted(docs, reverse=True)
    rows = {r.doc_id: r for r in QUERIES["op4_imatch"](spark, sf_dir).collect()}
    assert sorted(rows) == sorted(docs)
    for i, doc_id in enumerate(order):
        text, after = docs[doc_id], docs[order[(i + 1) % len(order)]]
        third = len(text) // 3
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()
        if docs[order[(i + 1) % len(order)]] == text:
            assert row.near_next == 1.0
    by_text = {}
    for doc_id, text in docs.items():
        assert by_text.setdefault(text, rows[doc_id].fingerprint) == rows[doc_id].fingerprint
    nearer = sum(r.near_edited > r.near_next for r in rows.values())
    assert nearer > 0.9 * len(rows)


def test_fingerprints_without_neighbours_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    alone = {r.doc_id: r.fingerprint for r in imatch.fingerprints(docs, ["doc_id"]).collect()}
    assert alone == {r.doc_id: r.fingerprint for r in imatch.compare_with_edits(docs).collect()}


@pytest.mark.parametrize("texts", [[], [(1, "only one")], [(1, None), (2, ""), (None, "no id"), (2, "again two words"), (2, "again two words"), (-(2**62), "far"), (2**62, "away")]])
def test_odd_tables(spark, texts):
    rows = fingerprint_rows(spark, texts).collect()
    assert len(rows) == len(texts)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.fingerprint for r in rows)


def test_no_python_in_the_fingerprint_plan(spark, sf_dir):
    plan = QUERIES["op4_imatch"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({"n_words": F.lit("a"), "rejected": F.lit("b"), "begins": F.lit("c"), "score": F.lit(1)})
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        out = spark.createDataFrame(out.collect(), out.schema)
        assert out.filter("n_words <> 'a' or rejected <> 'b' or begins <> 'c' or score <> 1").isEmpty()
        sizes.append(out.count())
        docs = out
    assert sizes[0] >= 0.99 * 200 and sizes[1] < sizes[0] and sizes[1] == sizes[2] == sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == sizes[3]


def test_pipeline_of_no_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() == 0
