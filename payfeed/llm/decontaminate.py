"""Benchmark decontamination through an FM-index of each training shard.

Test phrases are windows of ``WINDOW`` words of the benchmark items (a shorter item is one
window). A shard is a run of whole documents of a partition. It is written in the
alphabet of the phrases: every word that occurs in one has a number, runs of other words
are one separator, and stretches too short for any phrase are left out, as no phrase can
occur across or in them. Over that sequence a shard builds its suffix order, the
Burrows-Wheeler transform in a wavelet tree, and sampled suffix positions. All phrases
search backward at once; each step is two ranks in the tree. The rows found walk
to the nearest sampled position, which locates the occurrence; overlapping occurrences
merge to spans.

Documents never leave their task. Phrases come in blocks of at most ``PHRASES``, each
a broadcast of bounded size, and every block searches all documents.

Nulls, empty and repeated rows: null or wordless documents have no words and no hits; null or
wordless items have no window. A null item_id is no item. Items that repeat count once.
An empty benchmark hits nothing. Whole items of one word hit every such word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payfeed.llm.caches import claim
from payfeed.llm.rows import with_fields
from payfeed.session import materialize

WINDOW = 10
PHRASES = 100_000
SHARD_WORDS = 500_000
SAMPLE = 16
# Symbols that no phrase has: the end of an index, and whatever stands between known words.
END, SEPARATOR = 0, 1
# Bytes that separate words become spaces, A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def fold_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


class WaveletTree:
    """Ranks of symbols in a sequence; one bit row per bit of the alphabet (a wavelet matrix)."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.rows, self.zeros = [], []
        for level in range(bits - 1, -1, -1):
            bit = ((values >> level) & 1).astype(bool)
            # Ones before each position; 4 bytes a word of text and level, freed with the shard.
            self.rows.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(values) - int(self.rows[-1][-1]))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place, plus where its symbols begin."""
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            ones = self.rows[i][place]
            place = np.where((symbol >> level) & 1, self.zeros[i] + ones, place - ones)
        return place

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(place), np.int64)
        for i in range(self.bits):
            ones = self.rows[i][place]
            bit = self.rows[i][place + 1] - ones
            symbol = symbol << 1 | bit
            place = np.where(bit, self.zeros[i] + ones, place - ones)
        return symbol


def suffix_order(values: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling; settled positions drop out."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    rank = np.zeros(n, np.int64)
    changed = np.concatenate([[True], values[order][1:] != values[order][:-1]])
    rank[order] = np.flatnonzero(changed)[np.cumsum(changed) - 1]
    step = 1
    while True:
        tied = np.flatnonzero(~(changed & np.append(changed[1:], True)))
        if not len(tied):
            return order
        at = order[tied]
        follow = at + step
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        first = rank[at]
        again = np.lexsort((second, first))
        at, first, second = at[again], first[again], second[again]
        order[tied] = at
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        changed[tied] = new
        rank[at] = tied[np.flatnonzero(new)[np.cumsum(new) - 1]]
        step *= 2


class FMIndex:
    """Index of a sequence of symbols 0 to ``symbols`` - 1; 0 is its last symbol and nowhere else."""

    def __init__(self, values: np.ndarray, symbols: int, sample: int = SAMPLE):
        order = suffix_order(values)
        self.n, self.sample = len(values), sample
        last = values[order - 1]
        self.tree = WaveletTree(last, max(1, (symbols - 1).bit_length()))
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=symbols))])
        self.start = self.tree.rank(np.arange(symbols), np.zeros(symbols, np.int64))
        sampled = order % sample == 0
        self.sampled_before = np.concatenate([[0], np.cumsum(sampled, dtype=np.int32)])
        self.positions = order[sampled]

    def back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.begin[symbol] + self.tree.rank(symbol, row) - self.start[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases; ``phrases`` holds each right-aligned in its row."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((step < lengths) & (low < high))
            symbol = phrases[live, phrases.shape[1] - 1 - step]
            low[live], high[live] = self.back(symbol, low[live]), self.back(symbol, high[live])
        return low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions of rows: walk back to a sampled one (position 0 is one)."""
        where, walked = np.full(len(row), -1, np.int64), 0
        open_rows, row = np.arange(len(row)), row.copy()
        while len(open_rows):
            now = row[open_rows]
            known = self.sampled_before[now + 1] > self.sampled_before[now]
            where[open_rows[known]] = self.positions[self.sampled_before[now[known]]] + walked
            open_rows, now = open_rows[~known], now[~known]
            row[open_rows] = self.back(self.tree.access(now), now)
            walked += 1
        return where


class _Phrases:
    """One block of phrases in numbers."""

    def __init__(self, texts: list[bytes], items: list[list[str]]):
        split = [t.split(b" ") for t in texts]
        self.numbers: dict[bytes, int] = {}
        for words in split:
            for word in words:
                self.numbers.setdefault(word, len(self.numbers) + 2)
        self.lengths = np.array([len(w) for w in split], np.int64)
        self.table = np.zeros((len(split), int(self.lengths.max(initial=1))), np.int64)
        for i, words in enumerate(split):
            self.table[i, -len(words) :] = [self.numbers[w] for w in words]
        self.items = items
        self.shortest = int((self.lengths.min() if len(self.lengths) else 1))


def _search_shard(docs: list[list[bytes]], phrases: _Phrases) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per document: begins and ends of occurrences, and their phrases."""
    get = phrases.numbers.get
    numbers, ends = [], []
    for words in docs:
        numbers += [get(w, SEPARATOR) for w in words]
        numbers.append(SEPARATOR)
        ends.append(len(numbers))
    values = np.array(numbers, np.int64)
    # Stretches of known words that are long enough, each with one separator behind it.
    edge = np.flatnonzero(np.diff(np.concatenate([[False], values > SEPARATOR, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    fit = end - begin >= phrases.shortest
    begin, end = begin[fit], end[fit] + 1
    if not len(begin):
        return {}
    sizes = end - begin
    kept = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    index = FMIndex(np.append(values[kept], END), len(phrases.numbers) + 2)
    low, high = index.search(phrases.table, phrases.lengths)
    times = high - low
    if not times.sum():
        return {}
    phrase = np.repeat(np.arange(len(times)), times)
    rows = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
    first = kept[index.locate(rows)]
    ends = np.array(ends)
    doc = np.searchsorted(ends, first, "right")
    first -= np.concatenate([[0], ends])[doc]
    order = np.lexsort((first, doc))
    doc, first, phrase = doc[order], first[order], phrase[order]
    cuts = np.flatnonzero(np.diff(doc)) + 1
    return {
        int(d[0]): (f, f + phrases.lengths[p], p)
        for d, f, p in zip(np.split(doc, cuts), np.split(first, cuts), np.split(phrase, cuts))
    }


def benchmark_phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of items: phrase (words joined by spaces) and the ids of its items."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item_id, text in zip(batch["item_id"], batch["text"]):
                words = fold_words(text)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    rows.append((b" ".join(words[i : i + window]), item_id))
            yield pd.DataFrame(rows, columns=["phrase", "item_id"])

    source = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null")
    return source.mapInPandas(cut, "phrase binary, item_id string").distinct()


def find_phrases(docs: DataFrame, items: DataFrame, columns: list[str], window: int = WINDOW, cut: bool = False) -> DataFrame:
    """Rows of ``docs`` (``columns``) with n_words, spans of hit words and hit item_ids.

    ``begins`` and ``ends`` are merged spans in words, ``item_ids`` the distinct items, sorted as strings.
    With ``cut``, ``text`` without the spans (as ``without_spans`` gives it) takes the place of these.
    """
    spark = docs.sparkSession
    phrases = materialize(benchmark_phrases(items, window), "phrases")
    blocks = max(1, -(-phrases.count() // PHRASES))
    kept = docs.select(*columns, F.col("text").cast("string").alias("_text"))
    result_fields = [("n_words", "long"), ("begins", "array<int>"), ("ends", "array<int>"), ("item_ids", "array<string>")]
    out = kept
    for number in range(blocks):
        # One block at a time: at most about PHRASES pairs of a phrase and an item.
        mine = phrases.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == number)
        texts: dict[bytes, list[str]] = {}
        for phrase, item_id in mine.toLocalIterator():
            texts.setdefault(bytes(phrase), []).append(item_id)
        block = spark.sparkContext.broadcast((list(texts), list(texts.values())))
        out = _search_block(out, columns, block, result_fields, first=number == 0, cut=cut and number == blocks - 1)
    return out if cut else out.select(*columns, *(name for name, _ in result_fields))


def _search_block(rows: DataFrame, columns: list[str], block, result_fields, first: bool, cut: bool) -> DataFrame:
    keep = [c for c in rows.columns]
    names = [n for n, _ in result_fields]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("phrases")
        phrases = _Phrases(*block.value)
        for batch in batches:
            words, at, size = [], 0, 0
            texts = batch.column("_text").to_pylist()
            for i, text in enumerate(texts):
                words.append(fold_words(text))
                size += len(words[-1])
                if size >= SHARD_WORDS or i == len(texts) - 1:
                    found = _search_shard(words, phrases)
                    merged = _merged(batch.slice(at, len(words)), words, found, phrases, keep, names, first)
                    yield _shortened(merged, columns) if cut else merged
                    words, at, size = [], i + 1, 0

    if cut:
        return rows.mapInArrow(search, with_fields(rows.select(*columns).schema, "text string"))
    base = StructType([f for f in rows.schema.fields if f.name not in names])
    return rows.mapInArrow(search, with_fields(base, ", ".join(f"{n} {t}" for n, t in result_fields)))


def _merged(batch: pa.RecordBatch, words, found, phrases: _Phrases, keep, names, first: bool) -> pa.RecordBatch:
    """``batch`` with the spans and items found added to those of earlier blocks."""
    begins, ends, items = [], [], []
    before = None if first else list(zip(*(batch.column(n).to_pylist() for n in names[1:])))
    for i in range(len(words)):
        begin, end, phrase = found.get(i, (np.zeros(0, np.int64),) * 3)
        item_ids = {x for p in set(phrase.tolist()) for x in phrases.items[p]}
        if before:
            begin, end = np.concatenate([begin, before[i][0]]).astype(np.int64), np.concatenate([end, before[i][1]]).astype(np.int64)
            order = np.argsort(begin, kind="stable")
            begin, end = begin[order], end[order]
            item_ids |= set(before[i][2])
        if len(begin):
            reach = np.maximum.accumulate(end)
            new = np.concatenate([[True], begin[1:] > reach[:-1]])
            begin, end = begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
        begins.append(begin.tolist())
        ends.append(end.tolist())
        items.append(sorted(item_ids))
    columns = [c for c in keep if c not in names]
    arrays = [batch.column(c) for c in columns]
    arrays += [pa.array(list(map(len, words)), pa.int64()), pa.array(begins, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(arrays, names=columns + names)


def n_hit() -> F.Column:
    """Words inside spans."""
    return F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)


_TEXT_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def without_spans(found: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the ``text`` of rows from ``find_phrases`` without their spans.

    What lies between the first and the last word of a span goes with them; a text without spans stays
    as it is.
    """
    rows = found.select(*columns, F.col("text").cast("string").alias("_text"), "begins", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _shortened(batch, columns)

    return rows.mapInArrow(run, with_fields(rows.select(*columns).schema, "text string"))


def _shortened(batch: pa.RecordBatch, columns: list[str]) -> pa.RecordBatch:
    """``columns`` and the texts of ``batch`` without their spans."""
    texts = batch.column("_text").to_pylist()
    for i, (begins, ends) in enumerate(zip(batch.column("begins").to_pylist(), batch.column("ends").to_pylist())):
        if begins:
            places = [m.span() for m in _TEXT_WORD.finditer(texts[i])]
            kept, at = [], 0
            for begin, end in zip(begins, ends):
                kept.append(texts[i][at : places[begin][0]])
                at = places[end - 1][1]
            texts[i] = "".join([*kept, texts[i][at:]])
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts, pa.string())], names=[*columns, "text"])
