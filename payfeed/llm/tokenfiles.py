"""Token files: one concatenated id array per file, document boundaries in Elias-Fano form.

A file holds, in this order: a fixed header; the ids of its documents, 2 or 4 bytes each;
the doc_ids and the document ends as Elias-Fano sequences. Such a sequence stores the low
bits of each value as they are and the high bits in unary, about 2 + log2(universe / n) bits a
value, and answers select queries through counts of ones per 512 bits; there is no table
of 64-bit offsets. Files hold documents in ascending (doc_id, text hash) order, and
their manifest lists them in that order.

Nulls, ties: null texts are empty documents (the end id alone); null doc_ids come first;
rows that repeat a doc_id stay documents of their own. Empty input gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payfeed.llm.files import fresh_file, open_fs
from payfeed.llm.units import encoder
from payfeed.session import materialize, run_path

MAGIC = b"PFTOK001"
# magic, bytes an id, documents, of these with a null doc_id, ids, smallest doc_id,
# place and bytes of the doc_id and of the boundary sequence
HEADER = struct.Struct("<8sBxxxxxxxQQQqQQQQ")
BLOCK = 512
# Ids of one file, and bytes of ids that a reader holds at once.
FILE_IDS = 1 << 26
READ_BYTES = 8 << 20


class EliasFano:
    """A non-decreasing sequence of non-negative integers in compressed form."""

    HEAD = struct.Struct("<QBxxxxxxxQQQ")  # values, low bits, bytes of low part, of high part, of counts

    def __init__(self, data: bytes):
        self.n, self.low_bits, low, high, counts = self.HEAD.unpack_from(data)
        at = self.HEAD.size
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        self.counts = np.frombuffer(data, "<u4", counts // 4, at + low + high)

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), axis=None, bitorder="little") if low_bits else np.zeros(0, np.uint8)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-((int(places[-1]) + 1) if n else 0) // BLOCK) * BLOCK, np.uint8)
        bits[places] = 1
        counts = np.concatenate([[0], np.cumsum(bits.reshape(-1, BLOCK).sum(1, dtype=np.uint32))]).astype("<u4")
        high = np.packbits(bits, bitorder="little")
        return cls.HEAD.pack(n, low_bits, len(low), len(high), counts.nbytes) + low.tobytes() + high.tobytes() + counts.tobytes()

    def select(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` - 1: only the blocks that hold their ones are opened."""
        if first >= last:
            return np.zeros(0, np.int64)
        begin = int(np.searchsorted(self.counts, first, "right")) - 1
        end = int(np.searchsorted(self.counts, last, "left"))
        ones = np.flatnonzero(np.unpackbits(self.high[begin * BLOCK // 8 : end * BLOCK // 8], bitorder="little")) + begin * BLOCK
        skip = first - int(self.counts[begin])
        high = ones[skip : skip + last - first] - np.arange(first, last)
        if not self.low_bits:
            return high
        from_bit, to_bit = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[from_bit // 8 : -(-to_bit // 8)], bitorder="little")[from_bit % 8 :][: to_bit - from_bit]
        low = bits.reshape(-1, self.low_bits).astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return (high << self.low_bits) | low


class _Writer:
    """One file being written."""

    def __init__(self, folder: str, shard: int, number: int, width: int):
        self.path = fresh_file(folder, f"tokens-{shard:06d}-{number:04d}", ".bin")
        files, path = open_fs(self.path)
        self.ends: list[int] = []
        self.doc_ids: list[int] = []
        self.nulls = self.ids = 0
        self.width, self.shard, self.number = width, shard, number
        self.out = files.open_output_stream(path)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.ids += len(ids)
        self.ends.append(self.ids)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> tuple:
        least = self.doc_ids[0] if self.doc_ids else 0
        keys = EliasFano.encode(np.asarray(self.doc_ids, np.int64).astype(np.uint64) - np.uint64(least & (2**64 - 1)))
        ends = EliasFano.encode(np.asarray(self.ends, np.uint64))
        at = self.ids * self.width
        self.out.write(keys + ends)
        # The header needs the totals, so it stands at the end of the stream.
        self.out.write(HEADER.pack(MAGIC, self.width, len(self.ends), self.nulls, self.ids, least, at, len(keys), at + len(keys), len(ends)))
        self.out.close()
        return (self.shard, self.number, self.path, len(self.ends), self.ids)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, shards: int | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode all documents, write files in ascending doc_id order; returns their manifest.

    Manifest: shard, number, path, n_docs, n_ids, base (ids in the files before). ``shards``
    defaults to the session's shuffle partitions; a shard goes on in a further file beyond ``file_ids``.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path)
        width = 2 if max(encode.library.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        end = np.asarray([end_id], "<u4").tobytes()
        shard, number, writer, rows = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if writer and writer.ids >= file_ids:
                    rows.append(writer.close())
                    writer, number = None, number + 1
                writer = writer or _Writer(folder, shard, number, width)
                writer.add(None if pd.isna(doc_id) else int(doc_id), np.frombuffer(encode.encode(text or "") + end, "<u4"))
        if writer:
            rows.append(writer.close())
        yield pd.DataFrame(rows, columns=["shard", "number", "path", "n_docs", "n_ids"])

    source = docs.select(F.col("doc_id").cast("long").cast("decimal(20,0)").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = source.withColumn("_tie", F.xxhash64("text")).repartitionByRange(shards, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    manifest = materialize(ordered.select("doc_id", "text").mapInPandas(write, "shard int, number int, path string, n_docs long, n_ids long"), "manifest")
    before = Window.orderBy("shard", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, ids: bool = True) -> DataFrame:
    """Documents of the files of a manifest: doc_id, start, n_tokens, ids_crc32 and (if ``ids``) ids."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"]):
                yield from _read_file(path, int(base), ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    files = max(1, min(manifest.count(), 10 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.repartitionByRange(files, "shard", "number").mapInPandas(read, schema)


def _read_file(path: str, base: int, with_ids: bool) -> Iterator[pd.DataFrame]:
    files, path = open_fs(path)
    with files.open_input_file(path) as file:
        magic, width, n, nulls, n_ids, least, key_at, key_bytes, end_at, end_bytes = HEADER.unpack(file.read_at(HEADER.size, file.size() - HEADER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        keys = EliasFano(file.read_at(key_bytes, key_at))
        ends = EliasFano(file.read_at(end_bytes, end_at))
        done = 0
        while done < n:
            more = min(n, done + 4096)
            bounds = np.concatenate([[0] if done == 0 else ends.select(done - 1, done), ends.select(done, more)])
            # Whole documents of at most READ_BYTES, but one at least.
            fit = int(np.searchsorted((bounds[1:] - bounds[0]) * width, READ_BYTES, "right"))
            bounds = bounds[: max(1, fit) + 1]
            data = file.read_at(int(bounds[-1] - bounds[0]) * width, int(bounds[0]) * width)
            values = np.frombuffer(data, f"<u{width}").astype("<u4")
            more = done + len(bounds) - 1
            at = bounds - bounds[0]
            parts = [values[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
            doc_ids = [None] * max(0, min(more, nulls) - done) + [int(v) + least for v in keys.select(max(0, done - nulls), max(0, more - nulls))]
            out = pd.DataFrame({
                "doc_id": pd.array(doc_ids, "Int64"),
                "start": base + bounds[:-1],
                "n_tokens": np.diff(bounds),
                "ids_crc32": [zlib.crc32(p) for p in parts],
            })
            if with_ids:
                out["ids"] = parts
            yield out
            done = more


def token_documents(docs: DataFrame, tokenizer_path: str, ids: bool = False) -> DataFrame:
    """Write all documents as token files in the shared folder and read them back."""
    manifest = write_token_files(docs, tokenizer_path, run_path(docs.sparkSession, "tokens"))
    return read_token_files(manifest, ids)
