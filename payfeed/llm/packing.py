"""Best-fit packing of documents into sequences by exact-complement hashing.

Packing depends on lengths alone, and there are at most ``capacity`` of them. So Spark
counts pieces per length, the driver plans on that histogram (its size does not depend on
the number of documents), and Spark gives each piece its place: the k-th piece of a length
takes the k-th slot that the plan has for that length.

The plan fills sequences exactly wherever it can. Lengths are indexed by themselves, by
the sums of pairs and by the sums of triples; a sequence opened by a long piece asks the
index for the rest and consumes as many equal combinations at once as the counts allow.
What finds no exact complement is placed best-fit, longest first.

Nulls, empty and repeated rows: a null text is an empty document (one end id); rows that
repeat a doc_id are documents of their own. An empty table gives an empty result. Other
columns of the input are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payfeed.llm.units import encoder
from payfeed.session import materialize

CAPACITY = 2048
END_ID = 0


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """Documents as pieces: doc_id, piece, start, length, ids_crc32, text_key and (if ``ids``) ids.

    ``ids`` are little-endian unsigned 32-bit integers; only documents longer than
    ``capacity`` are cut. ``text_key`` is a hash of the text.
    """
    end, width = np.asarray([end_id], "<u4").tobytes(), 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"]):
                data = encode(text or "") + end
                for piece, at in enumerate(range(0, len(data), width)):
                    part = data[at : at + width]
                    rows.append((doc_id, key, piece, at // 4, len(part) // 4, zlib.crc32(part)) + ((part,) if ids else ()))
            names = ["doc_id", "text_key", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("text_key", F.xxhash64("text"))
    schema = "doc_id long, text_key long, piece int, start long, length long, ids_crc32 long"
    return source.mapInPandas(cut, schema + (", ids binary" if ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences take each, for ``counts`` pieces per length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    made: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        made.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    pair_a, pair_b = _pair_index(left, capacity)
    for opener in range(capacity - 1, 0, -1):
        if left[opener]:
            for pattern in _complements(opener, left, capacity, pair_a, pair_b):
                need = Counter(pattern)
                copies = min(int(left[x]) // k for x, k in need.items())
                if copies:
                    for x, k in need.items():
                        left[x] -= k * copies
                    made.append((pattern, copies))
                if not left[opener]:
                    break
    return made + _best_fit(left, capacity)


def _pair_index(left: np.ndarray, capacity: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each sum the pairs of lengths (a >= b) that make it, largest a first."""
    have = np.flatnonzero(left)
    in_use = left > 0
    pair_a, pair_b = [], []
    for total in range(capacity):
        b = have[have <= total // 2]
        b = b[in_use[total - b]]
        pair_a.append(total - b)
        pair_b.append(b)
    return pair_a, pair_b


def _complements(opener: int, left: np.ndarray, capacity: int, pair_a: list, pair_b: list) -> Iterator[tuple[int, ...]]:
    """Patterns that fill a sequence with ``opener``: one, two or three more pieces that are left."""
    gap = capacity - opener
    if left[gap]:
        yield (opener, gap)
    open_pairs = np.flatnonzero((left[pair_a[gap]] > 0) & (left[pair_b[gap]] > 0))
    for i in open_pairs:
        yield (opener, int(pair_a[gap][i]), int(pair_b[gap][i]))
    for largest in np.flatnonzero(left[: max(0, gap - 1)])[::-1]:
        rest = gap - int(largest)
        if rest > 2 * largest:
            break
        a, b = pair_a[rest], pair_b[rest]
        for i in np.flatnonzero((a <= largest) & (left[a] > 0) & (left[b] > 0)):
            if left[largest]:
                yield (opener, int(largest), int(a[i]), int(b[i]))


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit, longest first, over equal bins at once."""
    gaps: list[int] = []
    bins: dict[int, list[list]] = {}

    def put(gap: int, pattern: tuple[int, ...], count: int) -> None:
        if gap not in bins:
            bins[gap] = []
            insort(gaps, gap)
        bins[gap].append([pattern, count])

    for length in range(capacity, 0, -1):
        rest = int(left[length])
        while rest:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                if rest >= each:
                    put(capacity - each * length, (length,) * each, rest // each)
                    rest %= each
                else:
                    put(capacity - rest * length, (length,) * rest, 1)
                    rest = 0
                continue
            gap = gaps[at]
            pattern, count = bins[gap].pop()
            if not bins[gap]:
                del bins[gap], gaps[at]
            used = min(count, rest)
            if used < count:
                put(gap, pattern, count - used)
            put(gap - length, (*pattern, length), used)
            rest -= used
    return [(pattern, count) for groups in bins.values() for pattern, count in groups]


def _slots(made: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Per run of equal slots: key of its first rank, that rank, first sequence, offset; sorted by key."""
    taken: Counter[int] = Counter()
    runs, sequence = [], 0
    for pattern, copies in made:
        offset = 0
        for length in pattern:
            runs.append((length << 48 | taken[length], taken[length], sequence, offset))
            taken[length] += copies
            offset += length
        sequence += copies
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return tuple(np.ascontiguousarray(table[:, i]) for i in range(4))


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY, chunks: int | None = None) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with sequence_id and offset.

    ``pieces`` is read twice, so it should be a written table. ``order`` are columns that
    fix the order of pieces of one length. A length may hold any share of the rows: ranks are
    counted in ``chunks`` by hash (default: the session's shuffle partitions) and joined
    to the sum of the chunks before.
    """
    spark = pieces.sparkSession
    chunks = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    key, first, sequence, offset = _slots(plan({int(r["length"]): int(r["count"]) for r in counted}, capacity))

    chunked = pieces.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = chunked.groupBy("length", "_chunk").count().select(
        "length", "_chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("length", "_chunk").orderBy(*order)
    ranked = chunked.withColumn("_rank", F.row_number().over(within) - 1).join(bases, ["length", "_chunk"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_chunk", "_base")

    plan_table = spark.sparkContext.broadcast((key, first, sequence, offset))
    names = [f.name for f in pieces.schema.fields]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, first, sequence, offset = plan_table.value
        for batch in batches:
            rank = batch["_rank"].to_numpy(np.int64)
            run = np.searchsorted(key, (batch["length"].to_numpy(np.int64) << 48) | rank, "right") - 1
            out = batch[names].copy()
            out["sequence_id"] = sequence[run] + rank - first[run]
            out["offset"] = offset[run]
            for name in names:
                if out[name].dtype.kind == "f":
                    out[name] = out[name].astype("Int64")
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInPandas(place, f"{schema}, sequence_id long, offset long")


def packed_sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences from placed pieces with ``ids``: sequence_id, length, ids. A sequence holds ``capacity`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, part: F.concat(acc, part["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """All documents cut and placed; pieces are written once to the shared folder and placed from there."""
    pieces = materialize(cut_pieces(docs, tokenizer_path, capacity, end_id, ids), "pieces")
    order = ["doc_id", "piece", "text_key", "ids_crc32"]
    return pack(pieces, order, capacity).drop("text_key")
