"""From documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from payfeed.llm import decontaminate, language, packing, simhash, substrings  # noqa: E402
from payfeed.llm.files import reach_workers  # noqa: E402
from payfeed.llm.rows import as_struct  # noqa: E402
from payfeed.llm.queries import public_tokenizer  # noqa: E402
from payfeed.session import materialize  # noqa: E402


def _whole(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` beside the whole row, so no column can clash with a result."""
    return docs.select("doc_id", "text", as_struct(docs).alias("_row"))


def _changed(found: DataFrame, columns: list[str], text: F.Column) -> DataFrame:
    """Rows with ``text`` put in, and ``n_chars`` with it where it changed."""
    rows = found.select("_row", text.alias("_new"))
    same = F.col("_new").eqNullSafe(F.col("_row.text"))
    new = {"text": F.col("_new"), "n_chars": F.when(same, F.col("_row.n_chars")).otherwise(F.length("_new").cast("long"))} if "n_chars" in columns else {"text": F.col("_new")}
    return rows.select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or far from all centroids go."""
    reach_workers(spark)
    model = language.train(docs.filter(~language.held_out()))
    found = language.predict(_whole(docs), model, ["_row"])
    return found.filter("not rejected").select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: three-word shingles, fingerprints linked at three bits or fewer."""
    reach_workers(spark)
    return simhash.drop_near_duplicates(docs)


def remove_repeated_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated windows of 35 words; others keep their text as it is."""
    reach_workers(spark)
    found = substrings.remove_repeats(_whole(docs))
    return _changed(found, docs.columns, F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("_row.text")))


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ten words or more of benchmark items."""
    reach_workers(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    cut = decontaminate.find_phrases(_whole(docs), items, ["_row"], cut=True)
    return _changed(cut, docs.columns, F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2,048 ids."""
    reach_workers(spark)
    return packing.pack_documents(docs, public_tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_windows", remove_repeated_windows),
    ("decontamination", remove_benchmark_passages),
    ("packing", pack),
]

# Language models, SimHash groups and packing have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
