"""Merkle manifest of a table: an append log of nodes in postorder, and proofs out of it.

Each row is a leaf, each group of rows a tree, and the trees' roots are the leaves of one more
tree. ``FANOUT`` consecutive nodes of a level become one of the next (the last run may be shorter, even a
single node), while there is more than one. ``H`` is the lower-case hexadecimal SHA-256 of its inputs put
one after the other, digests as hexadecimal text.

A tree is built by aligned builders: one takes a block of ``FANOUT ** TIER`` consecutive nodes and appends the
nodes above them in the order in which they are complete, children before their parent. The blocks'
own roots are the nodes of the next tier, so a tree of any size takes a few rounds of bounded
tasks. A node's place in the log follows from its level, its index and the number of leaves (``position``),
because whole subtrees have known sizes. ``prove`` finds the siblings of a path by these places.

Hot groups: builders get blocks, whatever tree these belong to. Rows are numbered by a range exchange, never in one
task, and rows equal in all that they are ordered by are split further by what else they hold.

Nulls, ties, empties: a null group is a tree of its own and comes first; null in the order comes first; equal
rows are leaves each, and interchangeable. A lone leaf is its tree's root, a lone tree's root the root. An empty
table has no trees and no root. What is carried along stands in a struct, so its names cannot clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payfeed.operators.batching import number_rows
from payfeed.session import materialize

FANOUT = 8
_BITS = 3
TIER = 4
# The tree whose leaves are the roots of all others.
TOP = -1

PATH = "places array<int>, siblings array<string>, n long, subroot string, root string"
LOG = "tree long, level int, index long, position long, digest string"


def H(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def field(value: Column) -> Column:
    """A value as it goes into a leaf: ``-`` for null, else its number of UTF-8 bytes, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def height(n: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def position(level: int, index: int, n: int) -> int:
    """Place in the log, from 0, of the node with this index of a level of a tree of ``n`` leaves.

    It comes after all nodes of its level and below that end with its last leaf or before, and
    after the nodes of higher levels that end before.
    """
    end = min((index + 1) * FANOUT**level, n)
    below = sum(-(-end // FANOUT**m) for m in range(level + 1))
    above, size = 0, FANOUT ** (level + 1)
    while size < end:
        above, size = above + (end - 1) // size, size * FANOUT
    return below + above - 1


@dataclass(frozen=True)
class Manifest:
    """Written tables: leaves (tree, index, leaf, row), trees (tree, group, n, digest of the root), and the log."""

    leaves: DataFrame
    trees: DataFrame
    log: DataFrame
    n_trees: int
    most: int


def _grow(base_level: int):
    """A builder: (tree, block, n, index, digest) of one block to the log rows it appends."""

    def grow(key: tuple, block: pa.Table) -> pa.Table:
        tree, n = key[0].as_py(), block.column("n")[0].as_py()
        order = np.argsort(block.column("index").to_numpy())
        digests = block.column("digest").take(pa.array(order)).to_pylist()
        first = block.column("index")[int(order[0])].as_py()
        top = min(height(n), base_level + TIER)
        open_runs: list[list[str]] = [[] for _ in range(TIER + 1)]
        out: list[tuple] = []

        def append(level: int, index: int, digest: str) -> None:
            if level > base_level or base_level == 0:
                out.append((tree, level, index, position(level, index, n), digest))
            if level == top:
                return
            run = open_runs[level - base_level]
            run.append(digest)
            if len(run) == FANOUT or (index + 1) * FANOUT**level >= n:
                done = H(run)
                run.clear()
                append(level + 1, index // FANOUT, done)

        for i, digest in enumerate(digests):
            append(base_level, first + i, digest)
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "level", "index", "position", "digest"])

    return grow


def _above(index: Column, levels: int | Column) -> Column:
    """The index of the node that many levels above."""
    return F.call_function("shiftright", index, (F.lit(_BITS) * levels).cast("int"))


def _grown(base: DataFrame, sizes: DataFrame, most: int, label: str) -> DataFrame:
    """The log of all trees with ``base`` (tree, n, index, digest) as leaves; ``sizes`` has n by tree, at most ``most``."""
    logs, nodes, level = [], base, 0
    while True:
        blocks = nodes.withColumn("block", _above(F.col("index"), TIER)).groupBy("tree", "block")
        log = materialize(blocks.applyInArrow(_grow(level), LOG), label)
        logs.append(log)
        level += TIER
        if height(most) <= level:
            return reduce(DataFrame.unionByName, logs)
        # A tree that ends at this level has one node there and goes no further.
        higher = sizes.filter(F.col("n") > FANOUT**level).select("tree", "n")
        nodes = log.filter(F.col("level") == level).select("tree", "index", "digest").join(higher, "tree")


def _top_digest(log: DataFrame, trees: DataFrame) -> DataFrame:
    """``trees`` (tree, n, ...) with the digest of each one's root: the last node of its log."""
    last = log.groupBy("tree").agg(F.max_by("digest", "position").alias("digest"))
    return trees.join(last, "tree")


def build(items: DataFrame, group: str, order: list[str], leaf: str = "leaf") -> Manifest:
    """The manifest of ``items``: a tree per value of ``group``, its leaves in ``order``, then by digest.

    Other columns of ``items`` are carried as ``row``; they may not be maps.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in items.columns])
    keys = [F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)]
    leaves = items.select(F.col(f"`{group}`").alias("group"), *keys, F.col(f"`{leaf}`").alias("leaf"), row.alias("row"))
    numbered = number_rows(materialize(leaves, "leaves"), ["group", *[f"o{i}" for i in range(len(order))], "leaf"], "place")
    numbered = materialize(numbered.select("group", "leaf", "row", "place"), "numbered")
    sizes = materialize(numbered.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("start")), "sizes")
    trees = materialize(number_rows(sizes, ["group"], "tree"), "trees")
    named = trees.select(F.col("group").alias("_group"), "tree", "n", "start")
    leaves = numbered.join(named, F.col("group").eqNullSafe(F.col("_group")))
    leaves = materialize(leaves.select("tree", "n", (F.col("place") - F.col("start")).alias("index"), "leaf", "row"), "leaves")
    counts = trees.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("most")).first()
    log = _grown(leaves.select("tree", "n", "index", F.col("leaf").alias("digest")), trees, counts["most"] or 0, "log")
    trees = materialize(_top_digest(log, trees), "trees")
    roots = trees.select(F.lit(TOP).cast("long").alias("tree"), F.lit(counts["trees"]).cast("long").alias("n"), F.col("tree").alias("index"), "digest")
    log = log.unionByName(_grown(roots, roots.select("tree", "n").distinct(), counts["trees"], "top"))
    return Manifest(leaves, trees, log, counts["trees"], counts["most"] or 0)


_TEXT, _PLACES = pa.string(), pa.list_(pa.int32())
_NOTHING = [("position", None, pa.int64()), ("digest", None, _TEXT), ("n", 0, pa.int64()), ("places", [], _PLACES), ("siblings", [], pa.list_(_TEXT)), ("subroot", None, _TEXT), ("root", None, _TEXT)]


def _climb(base_level: int):
    """Paths of the nodes of a block: own siblings out of the log by their positions, then the block's own path."""

    def climb(key: tuple, nodes: pa.Table, side: pa.Table) -> pa.Table:
        if not nodes.num_rows:  # a block of which nothing is asked
            side = pa.table({c: pa.array([v], k) for c, v, k in _NOTHING})
        path = side.filter(pc.is_null(side.column("position"))).to_pylist()[0]
        log = side.filter(pc.is_valid(side.column("position"))).sort_by("position")
        at, digests, n = log.column("position").to_numpy(), log.column("digest").to_pylist(), path["n"]
        top = min(height(n), base_level + TIER)
        index = nodes.column("index").to_numpy()
        own: list[dict[int, str]] = []
        for level in range(base_level, top):
            found: dict[int, str] = {}
            count = -(-n // FANOUT**level)
            for parent in np.unique(index // FANOUT ** (level - base_level + 1)).tolist():
                children = range(parent * FANOUT, min((parent + 1) * FANOUT, count))
                run = [digests[i] for i in np.searchsorted(at, [position(level, c, n) for c in children]).tolist()]
                for k, child in enumerate(children):
                    found[child] = "".join(run[:k] + run[k + 1 :])
            own.append(found)
        places, siblings = [], []
        for i in index.tolist():
            steps = [i // FANOUT**k for k in range(top - base_level)]
            places.append([s % FANOUT for s in steps] + path["places"])
            siblings.append([found[s] for found, s in zip(own, steps)] + path["siblings"])
        size = len(places)
        new = [pa.array(places, pa.list_(pa.int32())), pa.array(siblings, pa.list_(pa.string()))]
        whole = [pa.array([path[c]] * size, k) for c, k in (("n", pa.int64()), ("subroot", pa.string()), ("root", pa.string()))]
        kept = nodes.drop_columns(["block"])
        for name, column in zip(["places", "siblings", "n", "subroot", "root"], new + whole):
            kept = kept.append_column(name, column)
        return kept

    return climb


def _climbed(nodes: DataFrame, log: DataFrame, paths: DataFrame, base_level: int) -> DataFrame:
    """``nodes`` (tree, index, ...) of one level with the paths to the root: n, places, siblings, subroot, root."""
    inside = (F.col("level") >= base_level) & (F.col("level") < base_level + TIER)
    block = _above(F.col("index"), F.lit(base_level + TIER) - F.col("level"))
    segment = log.filter(inside).select("tree", block.alias("block"), "position", "digest")
    side = segment.unionByName(paths, allowMissingColumns=True).groupBy("tree", "block")
    # Nodes may come out of the log themselves; fresh columns keep the two sides apart.
    nodes = nodes.select(*[F.col(f"`{c}`").alias(c) for c in nodes.columns])
    blocks = nodes.withColumn("block", _above(F.col("index"), TIER)).groupBy("tree", "block")
    return blocks.cogroup(side).applyInArrow(_climb(base_level), StructType(nodes.schema.fields + StructType.fromDDL(PATH).fields))


def _paths(nodes: DataFrame, log: DataFrame, seeds: DataFrame, most: int, label: str) -> DataFrame:
    """Paths of leaves: tier by tier from the top, each tier's paths begin those of the one below.

    ``seeds`` has a path per tree that leads on from its root; it starts where the tree's own top is.
    """
    paths = None
    for tier in range(max(1, -(-height(most) // TIER)) - 1, -1, -1):
        level = TIER * tier
        here = seeds.filter((F.col("n") <= FANOUT ** (level + TIER)) & (F.col("n") > (FANOUT**level if tier else 0)))
        paths = here if paths is None else here.unionByName(paths)
        if tier:
            higher = seeds.filter(F.col("n") > FANOUT**level).select("tree")
            starts = log.filter(F.col("level") == level).join(higher, "tree").select("tree", "index")
            paths = materialize(_climbed(starts, log, paths, level).withColumnRenamed("index", "block"), label)
    return _climbed(nodes, log, paths, 0)


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """Proofs of ``leaves`` (rows of ``manifest.leaves``; all by default).

    Adds places (its place in each run of its path, from the leaf up), siblings (the digests of
    the others of each run, one after the other), subroot and root.
    """
    leaves = manifest.leaves if leaves is None else leaves
    empty = [F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("siblings")]
    block = F.lit(0).cast("long").alias("block")
    top_log = manifest.log.filter(F.col("tree") == TOP)
    top = top_log.groupBy("tree").agg(F.max_by("digest", "position").alias("root"))
    seed = top.select("tree", block, F.lit(manifest.n_trees).cast("long").alias("n"), *empty, F.lit(None).cast("string").alias("subroot"), "root")
    subroots = manifest.trees.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("index"), F.col("n").alias("size"), F.col("digest").alias("own"))
    paths = _paths(subroots, top_log, seed, manifest.n_trees, "subroot_paths")
    seeds = materialize(paths.select(F.col("index").alias("tree"), block, F.col("size").alias("n"), "places", "siblings", F.col("own").alias("subroot"), "root"), "seeds")
    below = manifest.log.filter(F.col("tree") != TOP)
    return _paths(leaves.select("tree", "index", "leaf", "row"), below, seeds, manifest.most, "paths")


def fold(digest: Column, places: Column, siblings: Column) -> Column:
    """The root to which a leaf and the siblings of its path lead, whoever computes it."""
    width = 64
    step = lambda own, run: F.sha2(
        F.concat(run["siblings"].substr(F.lit(1), run["places"] * width), own, run["siblings"].substr(run["places"] * width + 1, F.length(run["siblings"]))), 256
    )
    return F.aggregate(F.arrays_zip(places.alias("places"), siblings.alias("siblings")), digest, step)
