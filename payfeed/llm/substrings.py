"""Removal of repeated word windows by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Each window has a minimiser, the least of the
hashes of its word ``GRAM``-grams, so equal windows have equal minimisers. Consecutive
windows that share one travel as one packed string, a super-k-mer, to the bucket of the
minimiser; there all windows are sorted by hash, counted, and what the hashes call equal is compared word
by word. Windows that occur more than once go back to their documents as ranges, and the words they cover are
removed.

Hot keys: grams that are frequent in the whole table are counted first and come last in
the order of minimisers, so a frequent passage attracts no windows that only touch it; windows
inside it are equal, and each chunk of documents sends equal super-k-mers once. A bucket
therefore gets a string at most once per chunk, whatever the number of copies, and keeps one copy of
it with four bytes for each chunk. Buckets grow in number with the table, and a task holds one bucket or one chunk
at a time.

Results of a bucket return to the chunk, which knows where its strings occur, and from
there as ranges to the documents. Chunks are named by partition and number, so the input must
be a plan that gives the same partitions when it is repeated, such as a table.

Nulls, empty and repeated rows: a null or empty text has no words and an empty result;
documents shorter than a window have none; repeated rows, same doc_id or not, are
documents whose windows all repeat. Rows are returned once each, with all other columns.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.llm.caches import claim
from payfeed.llm.rows import as_struct, from_struct, with_fields
from payfeed.session import materialize

WINDOW = 35
GRAM = 4
# Bytes of text in one chunk, windows of one bucket on average, and counters for frequent grams.
CHUNK_BYTES = 3_500_000
BUCKET_WINDOWS = 1_000_000
SLOTS = 1 << 18
# Bytes hashed at once.
_AT_ONCE = 1 << 19

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words in ``data``, by their bytes alone; they steer and order, and never decide."""
    letters, found, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(letters):
        size = _AT_ONCE
        white = _WHITE[letters[at : at + size]]
        while at + size < len(letters) and not white.any():
            size *= 2
            white = _WHITE[letters[at : at + size]]
        if at + size < len(letters):  # up to the last white space
            size = len(white) - int(np.argmax(white[::-1]))
            white = white[:size]
        found.append(_hashes(letters[at : at + size], white))
        at += size
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _hashes(letters: np.ndarray, white: np.ndarray) -> np.ndarray:
    begins = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    if not len(begins):
        return np.zeros(0, np.uint64)
    # Where a word begins among the letters: its place without the white space before it.
    first = begins - np.cumsum(white)[begins]
    letters = letters[~white]
    sizes = np.diff(np.append(first, len(letters)))
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    return mixed(np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * powers[place], first))


def rolled(values: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Polynomial hashes (mod 2**64) of all runs of ``size`` values, by doubling."""

    def raised(n: int) -> np.uint64:
        return np.uint64(pow(factor, n, 1 << 64))

    done, done_size, part, part_size = None, 0, values, 1
    rest = size
    while rest:
        if rest & 1:
            if done is None:
                done, done_size = part, part_size
            else:
                n = len(values) - done_size - part_size + 1
                done = done[: max(0, n)] * raised(part_size) + part[done_size : done_size + max(0, n)]
                done_size += part_size
        rest >>= 1
        if rest:
            n = max(0, len(part) - part_size)
            part = part[:n] * raised(part_size) + part[part_size : part_size + n]
            part_size *= 2
    return done


def mixed(values: np.ndarray) -> np.ndarray:
    """Bits spread evenly."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of ``size`` values."""
    out, done = values, 1
    while done < size:
        step = min(done, size - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def _words(text) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def gram_slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = mixed(rolled(hashes, GRAM, 0xD6E8FEB86659FD93))
    return grams, (grams >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _joined(texts) -> Iterator[bytes]:
    """Texts one after the other, in parts of about a chunk."""
    held, size = [], 0
    for text in texts:
        if text:
            held.append(text.encode("utf-8", "replace"))
            size += len(held[-1])
            if size >= CHUNK_BYTES:
                yield b"\n".join(held)
                held, size = [], 0
    yield b"\n".join(held)


def frequent_slots(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Counters that hold far more grams than their share, and the number of words, over all documents.

    They steer strings to buckets and have no influence on results.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("grams")
        counts, n_words = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for data in _joined(batch["text"]):
                hashes = word_hashes(data)
                n_words += len(hashes)
                if len(hashes) >= GRAM:
                    counts += np.bincount(gram_slots(hashes)[1], minlength=SLOTS)
        high = np.flatnonzero(counts > 2 * n_words / SLOTS + 4)
        yield pd.DataFrame({"slot": np.concatenate([[-1], high]), "n": np.concatenate([[n_words], counts[high]])})

    found = docs.select("text").mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = materialize(found, "slots")
    total = int(found.filter("slot = -1").agg(F.sum("n")).first()[0] or 0)
    high = found.filter((F.col("slot") >= 0) & (F.col("n") > 4 * total / SLOTS + 16)).select("slot").toPandas()  # at most SLOTS rows
    return np.sort(high["slot"].to_numpy(np.int64)), total


class _Chunk:
    """Super-k-mers of some whole documents."""

    def __init__(self):
        self.doc_ids: list = []
        self.keys: list[int] = []
        self.texts: list[bytes] = []
        self.counts: list[int] = []
        self.size = 0

    def add(self, doc_id, key: int, text: str | None) -> None:
        words = _words(text)
        self.doc_ids.append(doc_id)
        self.keys.append(key)
        self.counts.append(len(words))
        if words:
            self.texts.append(b" ".join(words))
            self.size += len(self.texts[-1])

    def rows(self, name: str, frequent: np.ndarray, buckets: int, window: int) -> Iterator[tuple]:
        """(dest, chunk, kind, bucket, payload): strings by bucket, then where they occur."""
        text = b" ".join(self.texts)
        n, ends = sum(self.counts), np.cumsum(self.counts)
        if n < window:
            return
        grams, slots = gram_slots(word_hashes(text))
        order = grams >> np.uint64(1)
        order[frequent[slots]] |= np.uint64(1 << 63)
        least = _least(order, window - GRAM + 1)
        doc = np.repeat(np.arange(len(ends)), self.counts)
        starts = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
        if not len(starts):
            return
        least = least[starts]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(starts) != 1) | (least[1:] != least[:-1])]))
        run_start, run_len = starts[first], np.diff(np.append(first, len(starts)))
        bucket = (mixed(least[first]) % np.uint64(buckets)).astype(np.int64)
        offset = _word_offsets(text)
        begin, end = offset[run_start].tolist(), (offset[run_start + run_len + window - 1] - 1).tolist()
        # Equal strings of a chunk travel once; runs are put in the order of their buckets.
        by_bucket = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
        string_of = np.zeros(len(first), np.int64)
        packer = zstandard.ZstdCompressor(level=6)
        for runs in np.split(by_bucket, cuts):
            strings: dict[bytes, int] = {}
            of = [strings.setdefault(text[begin[r] : end[r]], len(strings)) for r in runs.tolist()]
            string_of[runs] = of
            often = (np.bincount(of, minlength=len(strings)) > 1).astype(np.uint8)
            number = int(bucket[runs[0]])
            yield number, name, 1, number, packer.compress(_packed(strings, often))
        table = np.stack([bucket, string_of, doc[run_start], run_start - np.concatenate([[0], ends[:-1]])[doc[run_start]]]).astype("<i4")
        present = np.array([d is not None for d in self.doc_ids], np.uint8)
        doc_ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        payload = struct.pack("<II", len(doc_ids), table.shape[1]) + present.tobytes() + doc_ids.tobytes() + np.array(self.keys, "<i8").tobytes() + table.tobytes()
        yield buckets + int(xxhash.xxh32_intdigest(name)), name, 0, -1, packer.compress(payload)


def _word_offsets(text: bytes) -> np.ndarray:
    """Where words begin that stand between single spaces, and one past the end's space."""
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    return np.concatenate([[0], spaces + 1, [len(text) + 1]])


def _packed(strings, often: np.ndarray) -> bytes:
    return struct.pack("<I", len(often)) + often.tobytes() + b"\n".join(strings)


class _Bucket:
    """Distinct strings of one bucket, and which chunk has sent which."""

    def __init__(self):
        self.strings: dict[bytes, int] = {}
        self.often = bytearray()
        self.chunks: list[tuple[str, np.ndarray]] = []

    def add(self, chunk: str, data: bytes) -> None:
        (n,) = struct.unpack_from("<I", data)
        of, strings, often = np.zeros(n, np.int32), self.strings, self.often
        for i, (string, flag) in enumerate(zip(data[4 + n :].split(b"\n"), data[4 : 4 + n])):
            at = strings.setdefault(string, len(strings))
            if at == len(often):
                often.append(flag)
            else:
                often[at] = 1  # two chunks have it
            of[i] = at
        self.chunks.append((chunk, of))

    def ranges(self, window: int) -> np.ndarray:
        """String, first and last word of what repeats, in the order of strings."""
        sizes = np.fromiter((x.count(b" ") for x in self.strings), np.int64, len(self.strings)) + 1
        text = b" ".join(self.strings)
        self.strings = {}
        windows = sizes - window + 1
        string = np.repeat(np.arange(len(sizes), dtype=np.int32), windows)
        shift = np.cumsum(windows) - windows
        place = (np.arange(len(string)) - np.repeat(shift, windows)).astype(np.int32)
        at = np.repeat(np.cumsum(sizes) - sizes, windows) + place
        offset = _word_offsets(text)
        one = rolled(word_hashes(text), window, 0x9FB21C651E98DF25)[at]
        order = np.argsort(one)
        one = one[order]
        repeated = np.frombuffer(self.often, np.uint8)[string] > 0
        same = np.flatnonzero(one[1:] == one[:-1])
        left, right = order[same], order[same + 1]
        spans = [x.tolist() for x in (offset[at[left]], offset[at[left] + window] - 1, offset[at[right]], offset[at[right] + window] - 1)]
        equal = np.fromiter((text[a:b] == text[c:d] for a, b, c, d in zip(*spans)), bool, len(same))
        if not equal.all():
            doubtful = one[same[~equal]]
            _by_words(text, offset, at, order, one, np.unique(doubtful), window, repeated)
            equal &= ~np.isin(one[same], doubtful)
        repeated[left[equal]], repeated[right[equal]] = True, True
        hit = np.flatnonzero(repeated)
        if not len(hit):
            return np.zeros((3, 0), np.int64)
        new = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(string[hit]) != 0)])
        first, last = hit[new], hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)]
        return np.stack([string[first], place[first], place[last] + window]).astype(np.int64)


def _by_words(text: bytes, offset, at, order, hashes, doubtful, window: int, repeated: np.ndarray) -> None:
    """Mark what repeats among windows of a hash that different windows share."""
    for value in doubtful:
        members = order[np.searchsorted(hashes, value) : np.searchsorted(hashes, value, "right")]
        alike: dict[bytes, list[int]] = {}
        for m in members.tolist():
            alike.setdefault(text[offset[at[m]] : offset[at[m] + window] - 1], []).append(m)
        for group in alike.values():
            if len(group) > 1:
                repeated[group] = True


MOVED = "dest long, chunk string, kind int, bucket long, payload binary"


def _send(slots: np.ndarray, buckets: int, window: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("strings")
        frequent = np.zeros(SLOTS, bool)
        frequent[slots] = True
        part, number, chunk = TaskContext.get().partitionId(), 0, _Chunk()

        def flush() -> pd.DataFrame:
            return pd.DataFrame(list(chunk.rows(f"{part}-{number}", frequent, buckets, window)), columns=["dest", "chunk", "kind", "bucket", "payload"])

        for batch in batches:
            for doc_id, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"]):
                chunk.add(None if pd.isna(doc_id) else int(doc_id), key, text)
                if chunk.size >= CHUNK_BYTES:
                    yield flush()
                    number, chunk = number + 1, _Chunk()
        yield flush()

    return send


def _count(window: int):
    """Bucket by bucket: which windows of which strings occur more than once."""

    def settle(number: int, bucket: _Bucket) -> Iterator[tuple]:
        found = bucket.ranges(window)
        packer = zstandard.ZstdCompressor(level=1)
        for chunk, of in bucket.chunks if found.shape[1] else ():
            first, last = np.searchsorted(found[0], of), np.searchsorted(found[0], of, "right")
            times = last - first
            where = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            if len(where):
                mine = np.stack([np.repeat(np.arange(len(of)), times), found[1][where], found[2][where]])
                yield 0, chunk, 1, number, packer.compress(mine.astype("<i4").tobytes())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("buckets")
        at, bucket, unpacker = None, _Bucket(), zstandard.ZstdDecompressor()
        columns = ["dest", "chunk", "kind", "bucket", "payload"]
        for batch in batches:
            out = []
            for dest, chunk, kind, number, payload in batch.itertuples(index=False):
                if kind == 0:
                    out.append((dest, chunk, kind, number, payload))
                    continue
                if number != at and bucket.chunks:
                    out += settle(at, bucket)
                    bucket = _Bucket()
                at = number
                bucket.add(chunk, unpacker.decompress(payload))
            yield pd.DataFrame(out, columns=columns)
        yield pd.DataFrame(list(settle(at, bucket)) if bucket.chunks else [], columns=columns)

    return count


def _return(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunk by chunk: ranges of words of documents, from where strings occur and what repeats in them."""
    unpacker = zstandard.ZstdDecompressor()
    columns = ["doc_id", "text_key", "ranges"]
    chunk, doc_ids, keys, table, found = None, [], [], None, []

    def flush() -> Iterator[pd.DataFrame]:
        if not found:
            return
        doc, begin, end = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((begin, doc))
        doc, begin, end = doc[order], begin[order], end[order]
        cuts = np.flatnonzero(np.diff(doc)) + 1
        rows = [
            (doc_ids[int(d[0])], keys[int(d[0])], np.stack([b, e]).astype("<i4").tobytes())
            for d, b, e in zip(np.split(doc, cuts), np.split(begin, cuts), np.split(end, cuts))
        ]
        out = pd.DataFrame(rows, columns=columns)
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out

    for batch in batches:
        for _, name, kind, bucket, payload in batch.itertuples(index=False):
            data = unpacker.decompress(payload)
            if kind == 0:
                yield from flush()
                chunk, found = name, []
                n, runs = struct.unpack_from("<II", data)
                present, at = np.frombuffer(data, np.uint8, n, 8), 8 + n
                doc_ids = [int(d) if p else None for p, d in zip(present, np.frombuffer(data, "<i8", n, at))]
                keys = np.frombuffer(data, "<i8", n, at + 8 * n).tolist()
                table = np.frombuffer(data, "<i4", 4 * runs, at + 16 * n).reshape(4, -1)
                table = table[:, np.lexsort((table[1], table[0]))]
                continue
            if name != chunk:
                raise RuntimeError("ranges without their chunk: the input changed between attempts")
            string, begin, end = np.frombuffer(data, "<i4").reshape(3, -1)
            low, high = np.searchsorted(table[0], [bucket, bucket + 1])
            mine = table[:, low:high]
            first, last = np.searchsorted(mine[1], string), np.searchsorted(mine[1], string, "right")
            times = last - first
            where = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            shift = mine[3][where]
            found.append((mine[2][where], shift + np.repeat(begin, times), shift + np.repeat(end, times)))
    yield from flush()


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Ranges of words covered by repeated windows: doc_id, text_key, ranges.

    ``docs`` has doc_id, text and text_key (a hash of the text). ``ranges`` holds begins, then ends,
    as little-endian 32-bit integers; documents without any are absent.
    """
    slots, words = frequent_slots(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-words // BUCKET_WINDOWS))
    moved = docs.select("doc_id", "text_key", "text").mapInPandas(_send(slots, buckets, window), MOVED)
    counted = moved.repartition(parts, "dest").sortWithinPartitions("dest", "chunk").mapInPandas(_count(window), MOVED)
    back = counted.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind", "bucket")
    ranges = back.mapInPandas(_return, "doc_id long, text_key long, ranges binary")
    # Rows that repeat a document in full have the same ranges each.
    return ranges.groupBy("doc_id", "text_key").agg(F.first("ranges").alias("ranges"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept words, joined by one space, and n_words, n_removed."""
    text = F.col("text").cast("string")
    others = [c for c in docs.columns if c not in ("text", "n_words", "n_removed")]
    row = as_struct(docs.select(*[F.col(f"`{c}`") for c in others]))
    source = docs.select(row.alias("_row"), text.alias("_text"), F.xxhash64(text).alias("_key"), F.col("doc_id").cast("long").alias("_id"))
    keyed = source.select(F.col("_id").alias("doc_id"), F.col("_key").alias("text_key"), F.col("_text").alias("text"))
    # Written first, so that the strings are off the disks before the texts are shuffled.
    ranges = materialize(repeated_ranges(keyed, window), "ranges").select(F.col("doc_id").alias("_rid"), F.col("text_key").alias("_rkey"), F.col("ranges").alias("_ranges"))
    # Merged: a file of like ranges is far smaller than what it holds, so its size is no ground to broadcast it.
    joined = source.join(ranges.hint("merge"), F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_key") == F.col("_rkey")), "left")
    # Arrow keeps the other columns as they are.

    def keep(batches):
        import pyarrow as pa

        claim("kept words")
        for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
            texts, counts, removed = [], [], []
            for text, ranges in zip(batch.column("_text").to_pylist(), batch.column("_ranges").to_pylist()):
                words = _words(text)
                counts.append(len(words))
                if ranges:
                    begin, end = np.frombuffer(ranges, "<i4").reshape(2, -1)
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, begin, 1)
                    np.add.at(depth, end, -1)
                    words = list(compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))
                removed.append(counts[-1] - len(words))
                texts.append(b" ".join(words).decode("utf-8"))
            arrays = [batch.column("_row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["_row", "_text", "_words", "_removed"])

    found = joined.select("_row", "_text", "_ranges")
    found = found.mapInArrow(keep, with_fields(found.select("_row").schema, "_text string, _words long, _removed long"))
    results = [F.col(a).alias(b) for a, b in (("_text", "text"), ("_words", "n_words"), ("_removed", "n_removed"))]
    return found.select(*from_struct("_row", others), *results)
