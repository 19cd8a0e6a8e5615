"""Near-duplicate groups by SimHash and multi-index hashing.

A fingerprint is 64 bits: a bit is 1 if it is set in over half of the hashes of a text's
word shingles. Fingerprints link at ``max_distance`` or fewer differing bits. They are cut
into segments so that linked ones differ by at most one bit in at least one segment. Each
fingerprint stands in one table per segment under the segment's value, and looks there under
every value of the Hamming ball of radius 1 around its own. Of two values one bit apart
only the one with a 0 there looks for the other, so a pair meets once per segment. What
meets is verified on all 64 bits.

Equal fingerprints are one row from the start. Hot table entries are split into blocks
of ``BLOCK`` fingerprints, and each block is verified by itself against all that look there;
a block returns a spanning star per group instead of its pairs. Groups are then joined by
label propagation with shortcuts, each round a written table.

Tables that grow with the texts are sorted and merged, whatever the planner takes their size to be: it counts
the rows that an array is spread to as one, and would have the driver hold what looks small.

Nulls, empty texts, ties: a text without words (or null) has fingerprint zero, linked
like any other; a row without doc_id is never the smallest of its group, and a group of such rows
alone has a null id; repeated rows fall in one group. Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payfeed.llm.caches import claim
from payfeed.llm.rows import as_struct, from_struct, with_fields
from payfeed.session import materialize

SEED = 42
BLOCK = 2048


def simhash(text: str | None, shingle: int) -> int:
    """Fingerprint of one text as an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        pieces = [b" ".join(words)]
    else:
        pieces = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, SEED) for p in pieces], "<u8")
    set_in = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with the fingerprint of ``text`` as a (signed) long."""
    kept = docs.select(*columns, F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.fromiter((simhash(t, shingle) for t in batch["_text"]), np.uint64, len(batch))
            out = batch[columns].copy()
            for name in columns:
                if out[name].dtype.kind == "f":
                    out[name] = out[name].astype("Int64")
            yield out.assign(fingerprint=prints.view(np.int64))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*columns).schema.fields)
    return kept.mapInPandas(run, f"{schema}, fingerprint long")


def _segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of segments such that some segment of a linked pair differs by one bit at most."""
    count = max_distance // 2 + 1
    edges = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def deal(nodes: DataFrame, node: str, values: list[tuple[Column, int]]) -> DataFrame:
    """Who meets where in the tables of segments: key, block, node, member.

    ``values`` are the segments of a row of ``nodes`` and their bits. A row is an entry (``member``) under
    each of its own values, and looks under those that have one more bit. Only keys with entries are
    kept. Entries stand in one block of their key; whoever looks, entries included, looks in all.
    """
    homes = [F.lit(number << 56).bitwiseOR(value) for number, (value, _) in enumerate(values)]
    looks = [_one_more_bit(key, value, bits) for key, (value, bits) in zip(homes, values)]
    at = lambda keys, home: F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(home).alias("home")))
    home = nodes.select(F.explode(F.array(*homes)).alias("key"))
    sizes = home.groupBy("key").agg(F.count(F.lit(1)).alias("entries"))
    seekers = nodes.select(F.col(node).alias("node"), F.inline(F.concat(at(F.array(*homes), True), at(F.concat(*looks), False))))
    met = seekers.hint("merge").join(sizes, "key").withColumn("blocks", F.ceil(F.col("entries") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = met.select("key", "node", F.when(F.col("home"), own).alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    return dealt.select("key", "block", "node", F.coalesce(F.col("own") == F.col("block"), F.lit(False)).alias("member"))


def links(fingerprints: DataFrame, max_distance: int) -> DataFrame:
    """Edges (a, b) whose components are those of all links between distinct ``fingerprint`` values."""
    values = [
        (F.shiftrightunsigned("fingerprint", first).bitwiseAND(F.lit((1 << bits) - 1)), bits) for first, bits in _segments(max_distance)
    ]
    dealt = deal(fingerprints, "fingerprint", values)
    parts = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_in = dealt.repartition(parts, "key", "block").sortWithinPartitions("key", "block", F.desc("member"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = None
        for batch in batches:
            key, block = batch["key"].to_numpy(), batch["block"].to_numpy()
            prints, member = batch["node"].to_numpy().view(np.uint64), batch["member"].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            found = []
            for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])):
                if a == b:
                    continue
                at = (key[a], block[a])
                if group is None or group.at != at:
                    found += group.stars() if group else []
                    group = _Block(at, max_distance)
                found += group.add(prints[a:b], member[a:b])
            yield _edges(found)
        yield _edges(group.stars() if group else [])

    return sorted_in.mapInPandas(verify, "a long, b long")


def _one_more_bit(key: Column, value: Column, bits: int) -> Column:
    """``key`` with each of the bits set that are clear in ``value``."""
    clear = F.filter(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: F.getbit(value, i) == 0)
    return F.transform(clear, lambda i: key.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))


class _Block:
    """Entries of one block and the groups that whoever looked has joined."""

    def __init__(self, at: tuple, max_distance: int):
        self.at, self.max_distance = at, max_distance
        self.members = np.zeros(0, np.uint64)
        self.root = np.zeros(0, np.int64)

    def add(self, prints: np.ndarray, member: np.ndarray) -> list[tuple[int, int]]:
        """Entries come before others; returns edges from prints that are no entries to one they met."""
        new = prints[member]
        self.members = np.concatenate([self.members, new])
        self.root = np.concatenate([self.root, np.arange(len(self.root), len(self.root) + len(new))])
        out: list[tuple[int, int]] = []
        if len(self.members) == len(prints) == len(new) == 1:
            return out  # a lone entry; a lone looker may follow its entry in a batch of its own
        for at in range(0, len(prints), 1024):
            some = prints[at : at + 1024]
            near = np.bitwise_count(some[:, None] ^ self.members[None, :]) <= self.max_distance
            who, whom = np.nonzero(near)
            first = np.full(len(some), -1)
            first[who[::-1]] = whom[::-1]
            for i, j in zip(who, whom):
                self._join(first[i], j)
            for i in np.flatnonzero((first >= 0) & ~member[at : at + 1024]):
                out.append((int(some[i]), int(self.members[first[i]])))
        return out

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _join(self, i: int, j: int) -> None:
        if self.root[i] == self.root[j]:
            return
        a, b = self._find(i), self._find(j)
        if a != b:
            self.root[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple[int, int]]:
        return [(int(self.members[i]), int(self.members[r])) for i in range(len(self.members)) if (r := self._find(i)) != i]


def _edges(found: list[tuple[int, int]]) -> pd.DataFrame:
    pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]}).drop_duplicates()


def components(edges: DataFrame) -> DataFrame:
    """Nodes of ``edges`` (a, b) with the smallest node of their component: node, root."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
    both = materialize(both.filter("node != other").distinct(), "edges")
    labels = materialize(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("root")), "labels")
    while True:
        seen = both.hint("merge").join(labels.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("near"))
        step = labels.hint("merge").join(seen, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        # Shortcut: take over the label of the node that gives the label.
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        step = step.join(jump.hint("merge"), "root", "left").select("node", "old", F.least("root", "further").alias("root"))
        step = materialize(step, "labels")
        labels = step.select("node", "root")
        if step.filter("root != old").isEmpty():
            return labels


def grouped(prints: DataFrame, max_distance: int) -> DataFrame:
    """``prints`` (doc_id, fingerprint, ...) with component_id, the smallest doc_id of the component.

    ``prints`` is read several times and should be a written table.
    """
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    distinct = materialize(distinct, "fingerprints")
    roots = components(links(distinct.select("fingerprint"), max_distance))
    named = distinct.join(roots.withColumnRenamed("node", "fingerprint").hint("merge"), "fingerprint", "left")
    named = materialize(named.select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")), "named")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # A written side lets adaptive execution split a fingerprint that many copies share.
    names = materialize(named.hint("merge").join(least, "root").select("fingerprint", "component_id"), "components")
    return prints.join(names.hint("merge"), "fingerprint")


# What a row is known by until its text is needed again, in the order in which rows of a component are preferred.
_KEYS = ["none", "id", "text_key", "text_sum"]


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id; all columns as they came.

    A null doc_id stays only where its component has no other. Of rows with the same doc_id stays that with the least hash of
    its text, and of those with the same text too any one. Rows are known by doc_id and two hashes of the text (96 bits); texts are
    neither written nor moved before it is clear which rows stay.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    keys = [doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), F.xxhash64(text), F.hash(text)]
    keys = [key.alias(name) for key, name in zip(keys, _KEYS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("fingerprints")
        for batch in batches:
            texts = batch.column("text").to_pylist()
            prints = np.fromiter((simhash(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*map(batch.column, _KEYS), pa.array(prints)], names=[*_KEYS, "fingerprint"])

    texts = docs.select(*keys, text.alias("text"))
    printed = texts.mapInArrow(run, with_fields(texts.select(*_KEYS).schema, "fingerprint long"))
    printed = materialize(printed.groupBy("fingerprint", *_KEYS).agg(F.count(F.lit(1)).alias("copies")), "prints")
    first = F.min(F.struct(*_KEYS, "copies")).alias("first")
    distinct = materialize(printed.groupBy("fingerprint").agg(first), "fingerprints")
    roots = components(links(distinct.select("fingerprint"), max_distance)).withColumnRenamed("node", "fingerprint")
    named = distinct.join(roots.hint("merge"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    stay = materialize(named.groupBy("root").agg(F.min("first").alias("first")).select("first.*"), "stay")
    rows = docs.select(*keys, as_struct(docs).alias("row"))
    once, more = (stay.filter(many).select(*_KEYS).hint("merge") for many in ("copies = 1", "copies > 1"))
    kept = rows.join(once, _KEYS, "left_semi").select("row")
    if not more.isEmpty():
        kept = kept.unionAll(rows.join(more, _KEYS, "left_semi").groupBy(*_KEYS).agg(F.first("row").alias("row")).select("row"))
    return kept.select(*from_struct("row", docs.columns))


def near_duplicate_groups(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """Documents with fingerprint and component: doc_id, fingerprint (16 hex digits), component_id."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = materialize(with_fingerprint(source, shingle, ["doc_id"]), "prints")
    found = grouped(prints, max_distance)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
