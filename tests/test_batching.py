"""Batches and envelopes: exact, ordered, and safe with hot keys and copies."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from payfeed.operators import batching

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(3)
    data = [
        (random.choice(["x", "y"]), 1 if i % 3 == 0 else random.randint(1, 60), random.choice([None, 1, 2, 3]), i)
        for i in range(2000)
    ]
    return spark.createDataFrame(data, "source_db string, k int, d int, i int").repartition(7)


def ordered(rows, *columns):
    key = lambda r: tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in columns)
    return sorted(rows.collect(), key=key)


def test_number_rows_is_the_global_order(rows):
    got = batching.number_rows(rows, ["k", "d", "i"]).collect()
    want = [r.i for r in ordered(rows, "k", "d", "i")]
    assert [r.i for r in sorted(got, key=lambda r: r.row_index)] == want
    assert sorted(r.row_index for r in got) == list(range(2000))


def test_number_rows_of_nothing(rows):
    assert batching.number_rows(rows.where(F.lit(False)), ["k"]).count() == 0


def test_copies_are_split_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(batching, "_LOPSIDED_ROWS", 100)
    monkeypatch.setattr(batching, "_LOPSIDED", 1.5)
    calls = []
    place = batching._place
    monkeypatch.setattr(batching, "_place", lambda df, keys: calls.append(keys) or place(df, keys))
    copies = spark.range(3000).select(F.when(F.col("id") < 2600, 5).otherwise(F.col("id")).alias("k"))
    got = batching.number_rows(copies, ["k"])
    assert len(calls) == 2 and calls[1][-1] == "_copy"
    assert sorted(r.row_index for r in got.collect()) == list(range(3000))
    assert got.columns == ["k", "row_index"]


def test_batch_rows_per_source(rows):
    got = batching.batch_rows(rows, 250, ["k", "i"], within=("source_db",)).collect()
    for source in "xy":
        mine = sorted((r for r in got if r.source_db == source), key=lambda r: r.row_index)
        assert [r.row_index for r in mine] == list(range(len(mine)))
        assert [r.i for r in mine] == [r.i for r in sorted(mine, key=lambda r: (r.k, r.i))]
        assert all(r.batch_no == r.row_index // 250 for r in mine)
    assert len(got) == 2000


@pytest.mark.parametrize("n", [1, 7, 100])
def test_batch_keys_never_span(rows, n):
    got = batching.batch_keys(rows, "k", n, within=("source_db",)).collect()
    assert len(got) == 2000
    for source in "xy":
        keys = sorted({r.k for r in got if r.source_db == source})
        want = {k: i // n for i, k in enumerate(keys)}
        assert all(r.batch_no == want[r.k] for r in got if r.source_db == source)


def test_null_keys_and_sources_are_kept(spark):
    rows = spark.createDataFrame([(None, None, 1), ("x", None, 2), ("x", 3, 3)], "source_db string, k int, i int")
    got = batching.batch_keys(rows, "k", 1, within=("source_db",)).collect()
    assert sorted((r.i, r.batch_no) for r in got) == [(1, 0), (2, 0), (3, 1)]


def test_envelopes_keep_order_and_times(spark):
    data = [(b, i, f"v{i}", T0 + dt.timedelta(hours=(i * 7) % 11)) for b in range(3) for i in range(20)]
    random.shuffle(data)
    rows = spark.createDataFrame(data, "batch_no int, row_index int, v string, t timestamp_ntz")
    got = batching.envelopes(rows, ["v", "t"], ["batch_no"], ["row_index"], "t").collect()
    assert sorted((r.batch_no, r.batch_size) for r in got) == [(b, 20) for b in range(3)]
    for r in got:
        assert [x.v for x in r.records] == [f"v{i}" for i in range(20)]
        assert r.min_timestamp == min(x.t for x in r.records)
        assert r.max_timestamp == max(x.t for x in r.records)


def test_manifest_sorts_no_records(spark):
    """A batch's figures come from hashed sums; only a row per batch and error is ever sorted."""
    t = dt.datetime(2024, 1, 1)
    rows = [(s, b, t + dt.timedelta(hours=i), f"r{s}{b}{i}", ["low", None, "bad"][i % 3] if b else None) for s in ("e", None) for b in (0, 1) for i in range(7)]
    records = spark.createDataFrame(rows, "source_db string, batch_no int, time timestamp_ntz, record string, error string")
    packed = batching.manifest(records, ["source_db", "batch_no"], "record", "time", "error")
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and not re.search(r"SortAggregate\(.*partial_count", plan)
    got = {(r["source_db"], r["batch_no"]): r for r in packed.collect()}
    assert len(got) == 4
    for (_, batch), r in got.items():
        assert (r["batch_size"], r["min_timestamp"], r["max_timestamp"]) == (7, t, t + dt.timedelta(hours=6))
        assert r["error"] == ("bad" if batch else None)
    whole = records.groupBy("source_db", "batch_no").agg(
        F.concat_ws("-", *[F.sum(F.xxhash64("record", F.lit(n)).cast("decimal(38,0)")).cast("string") for n in (1, 2)]).alias("digest")
    )
    assert {(r["source_db"], r["batch_no"]): r["digest"] for r in whole.collect()} == {k: r["digest"] for k, r in got.items()}


def test_envelopes_sort_by_an_ordering_made_once(spark):
    """A lambda comparator builds a new ordering for every two records; nulls still come first inside a record's place."""
    rows = spark.createDataFrame([(k, p, f"v{k}{p}") for k in (1, 2) for p in (3, None, 1, 2)], "k int, p int, v string")
    folded = batching.envelopes(rows, ["v"], ["k"], ["p"])
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" in plan and "lambdafunction(if" not in plan.lower() and "array_sort" not in plan
    got = {r["k"]: [x["v"] for x in r["records"]] for r in folded.collect()}
    assert got == {k: [f"v{k}{p}" for p in (None, 1, 2, 3)] for k in (1, 2)}


def test_key_numbers_are_written_before_they_join(spark, tmp_path):
    """A side of known size, so that the rows, whose file may be far smaller than they are, stay where they lie."""
    spark.range(3000).select((F.col("id") % 30).alias("k"), F.repeat(F.lit("long "), 200).alias("v")).write.parquet(f"{tmp_path}/rows")
    batched = batching.batch_keys(spark.read.parquet(f"{tmp_path}/rows"), "k", 10, staged=True)
    assert any("/numbers-" in f for f in batched.inputFiles())
    got = {(r["batch_no"], r["n"], r["keys"]) for r in batched.groupBy("batch_no").agg(F.count("v").alias("n"), F.countDistinct("k").alias("keys")).collect()}
    assert got == {(0, 1000, 10), (1, 1000, 10), (2, 1000, 10)}


def test_shared_dir_follows_the_session(spark, monkeypatch):
    from payfeed import session

    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return "s3://bucket/warehouse/" if key == "spark.sql.warehouse.dir" else default

    assert session.shared_dir(Cluster) == "s3://bucket/warehouse/staged"
