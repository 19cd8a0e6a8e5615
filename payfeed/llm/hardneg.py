"""Hard negatives by exact inner-product search in cover trees.

Candidates are put in shards of ``SHARD`` rows, and each shard in a cover tree. Rows are augmented by one component
so that all have the norm of the longest; inner products with an anchor (augmented by zero) then follow
the angle alone. A node's covering radius is the largest angle between its centre and a row below;
children have centres apart by more than half their parent's radius and cover all of it within that, unless the fan-out is
used up, when their true radii stand. The triangle inequality on angles bounds all inner products below a node from
both sides. Descent is best-first for a block of anchors at once: in each round every anchor names the nodes with its highest
bounds, few in the first rounds and more in later ones, skips nodes outside all windows that are still open, and a node is
met by all anchors that name it in one product of matrices. Leaves are computed exactly, in floats that hold such integers
without rounding. Bounds are only widened by rounding, so results are those of comparing all rows.

The anchors are a stated query set: in blocks they go to every bin of shards, and each (anchor, bin) answers with
a few rows; what a tree has found closes windows for the next. Bins are equal in shards, and tasks are pairs of a bin and a piece
of the blocks. Neither trees nor blocks grow with the table, and a task holds the trees of one bin and one block
at a time. A vector that a third of the rows share fills nodes of radius zero, which are leaves.

Nulls, ties, odd values: rows with a null vec_id, label or vector, or any null or non-finite component take no part, nor
do rows with a component of ``LIMIT`` or more (scores would leave the integers that doubles hold). Vectors of
unlike length have no inner product. Equal scores: smaller vec_id first. "Other" rows are those of another vec_id; repeated
rows are candidates each, and anchors each. An empty table gives an empty result.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payfeed.llm.caches import claim
from payfeed.session import materialize

SHARD = 16_384
LEAF = 512
FAN = 64
BIN = 4
BLOCK = 1024
# A round of the descent takes so many times the nodes of the one before; rows found are sorted in when there are so many.
WIDER = 6
HELD = 1 << 15
LIMIT = 1 << 22
SLACK = 1e-6

INDEX = "shard long, tree binary"


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as arrays:
        return dict(arrays)


def quantised(vector: Column) -> Column:
    """floor(256 x) of each component, as longs."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(256.0)).cast("long"))


def candidates(table: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """The rows that take part: vec_id, label, v."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * 256 < LIMIT)
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), v.alias("x"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").filter(F.forall("x", finite))
    return rows.select("vec_id", "label", quantised(F.col("x")).alias("v"))


class CoverTree:
    """Rows of one shard and the nodes above them."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.ids, self.labels = arrays["ids"], arrays["labels"]
        self.norm = float(arrays["norm"])
        self.centre, self.radius = arrays["centre"], arrays["radius"]
        # Of leaves: rows [begin, end); of inner nodes: children [begin, end).
        self.begin, self.end, self.leaf = arrays["begin"], arrays["end"], arrays["leaf"]
        self.points = arrays["vectors"][self.centre].astype(np.float64)
        self.integers, self._as = arrays["vectors"], {}

    @property
    def vectors(self) -> np.ndarray:
        return self.rows(np.float64)

    def rows(self, kind: type) -> np.ndarray:
        """All rows as ``kind``, kept for the next block."""
        if kind not in self._as:
            self._as[kind] = self.integers.astype(kind)
        return self._as[kind]

    @staticmethod
    def grow(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> dict[str, np.ndarray]:
        exact = vectors.astype(np.float64)
        squares = np.einsum("ij,ij->i", exact, exact)
        norm = float(np.sqrt(squares.max()))
        unit = np.hstack([exact, np.sqrt(np.maximum(0.0, squares.max() - squares))[:, None]]) / (norm or 1.0)
        queue = [(np.arange(len(ids)), 0)]
        centre, radius, begin, end, leaf, rows = [], [], [], [], [], []
        filled, at = 0, 0
        while at < len(queue):
            members, middle = queue[at]
            at += 1
            nearest = unit[members] @ unit[middle]
            wide = float(np.arccos(np.clip(nearest.min(), -1, 1)))
            centre.append(middle)
            radius.append(wide)
            if len(members) <= LEAF or wide <= SLACK:
                leaf.append(True)
                begin.append(filled)
                filled += len(members)
                end.append(filled)
                rows.append(members)
                continue
            owner, centres = np.zeros(len(members), np.int64), [middle]
            while len(centres) < min(FAN, max(2, len(members) // LEAF)):
                far = int(np.argmin(nearest))
                if len(centres) > 1 and np.arccos(np.clip(nearest[far], -1, 1)) <= wide / 2:
                    break
                near = unit[members] @ unit[members[far]]
                owner[near > nearest] = len(centres)
                owner[far] = len(centres)
                nearest = np.maximum(nearest, near)
                nearest[far] = 1.0
                centres.append(int(members[far]))
            leaf.append(False)
            begin.append(len(queue))
            queue += [(members[owner == k], c) for k, c in enumerate(centres)]
            end.append(len(queue))
        order = np.concatenate(rows)
        back = np.empty(len(ids), np.int64)
        back[order] = np.arange(len(ids))
        return {
            "ids": ids[order], "labels": labels[order], "vectors": vectors[order].astype(np.int32), "norm": np.array(norm), "centre": back[np.array(centre)],
            "radius": np.array(radius), "begin": np.array(begin), "end": np.array(end), "leaf": np.array(leaf),
        }

    def bounds(self, query: np.ndarray, length: np.ndarray | float, nodes: slice) -> tuple[np.ndarray, np.ndarray]:
        """Highest and lowest inner product that rows below the nodes can have, with a query or with each row of several."""
        reach = np.expand_dims(np.asarray(length, np.float64) * self.norm, -1)
        angle = np.arccos(np.clip(query @ self.points[nodes].T / np.where(reach > 0, reach, 1), -1, 1))
        high = np.cos(np.maximum(0, angle - self.radius[nodes]))
        low = np.cos(np.minimum(np.pi, angle + self.radius[nodes]))
        return reach * (high + SLACK), reach * (low - SLACK)

    def search(self, query: np.ndarray, vec_id: int, label: int, same: bool, lows: np.ndarray, highs: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window [low, high] the first ``k`` rows inside: scores and ids, of the anchor's label or of others."""
        asked = Asked(query[None, :], np.array([vec_id]), np.array([label]), same, lows[None, :], highs[None, :], k)
        self.answer(asked)
        return [(asked.scores[0, w, :n], asked.ids[0, w, :n]) for w, n in enumerate(asked.filled[0].tolist())]

    def answer(self, asked: Asked) -> None:
        """Put into ``asked`` what its queries look for among the rows of this tree."""
        # Partial sums are below the product of the norms, so single floats hold them where that is below 2**24.
        exact = np.float32 if asked.length.max() * self.norm < 1 << 24 else np.float64
        queries, rows = asked.queries.astype(exact), self.rows(exact)

        def offer(who: np.ndarray, first: int, last: int) -> tuple[np.ndarray, ...]:
            high, low = self.bounds(asked.queries[who], asked.length[who], slice(first, last))
            inside = np.zeros(high.shape, bool)
            for w in range(asked.floors.shape[1]):
                inside |= (high >= asked.floors[who, w, None]) & (low <= asked.highs[who, w, None])
            i, j = np.nonzero(inside)
            return who[i], first + j, high[i, j]

        who, node, high = offer(np.arange(len(queries)), 0, 1)
        width = 1
        while len(who):
            if width < len(self.leaf):
                order = np.lexsort((-high, who))
                who, node, high = who[order], node[order], high[order]
                now = _places(who) < width
            else:
                now = np.ones(len(who), bool)
            later = [(who[~now], node[~now], high[~now])]
            order = np.argsort(node[now], kind="stable")
            some, at = who[now][order], node[now][order]
            cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
            for n, mine in zip(at[np.append(0, cuts)].tolist(), np.split(some, cuts)):
                begin, end = int(self.begin[n]), int(self.end[n])
                if self.leaf[n]:
                    asked.meet(mine, queries[mine] @ rows[begin:end].T, self.ids[begin:end], self.labels[begin:end])
                else:
                    later.append(offer(mine, begin, end))
            if width < len(self.leaf):
                asked.settle()
            who, node, high = (np.concatenate(x) for x in zip(*later))
            open_ = high >= asked.floors.min(1)[who]
            who, node, high = who[open_], node[open_], high[open_]
            width *= WIDER
        asked.settle()


def _places(values: np.ndarray) -> np.ndarray:
    """Place of each value among its equals, which stand together."""
    first = np.concatenate([[True], values[1:] != values[:-1]])[: len(values)]
    return np.arange(len(values)) - np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))


class Asked:
    """A block of queries, and per query and window [low, high] the first ``k`` rows so far: best scores, then smaller ids."""

    def __init__(self, queries: np.ndarray, vec_ids: np.ndarray, labels: np.ndarray, same: bool, lows: np.ndarray, highs: np.ndarray, k: int):
        self.queries, self.vec_ids, self.labels, self.same, self.k = queries, vec_ids, labels, same, k
        self.length = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        # No row below a floor can be among the first of a window.
        self.floors, self.highs = lows.astype(np.float64), highs.astype(np.float64)
        self.scores, self.ids = np.zeros((*lows.shape, k)), np.zeros((*lows.shape, k), np.int64)
        self.filled = np.zeros(lows.shape, np.int64)
        self._met: list[tuple[np.ndarray, ...]] = []
        self._held = 0

    def meet(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """``scores`` of the queries ``who`` (rows) with some rows (columns)."""
        i, j = np.nonzero((scores >= self.floors.min(1)[who, None]) & (scores <= self.highs.max(1)[who, None]))
        own = who[i]
        fits = np.flatnonzero(((labels[j] == self.labels[own]) == self.same) & (ids[j] != self.vec_ids[own]))
        i, j = i[fits], j[fits]
        self._met.append((own[fits], scores[i, j].astype(np.float64), ids[j]))
        self._held += len(fits)
        if self._held > HELD:
            self.settle()

    def settle(self) -> None:
        """Sort in what was met."""
        if not self._held:
            return
        own, scores, ids = (np.concatenate(x) for x in zip(*self._met))
        self._met, self._held = [], 0
        for w in range(self.floors.shape[1]):
            take = (scores >= self.floors[own, w]) & (scores <= self.highs[own, w])
            if not take.any():
                continue
            q, s, i = own[take], scores[take], ids[take]
            known = np.unique(q)
            a, b = np.nonzero(np.arange(self.k) < self.filled[known, w, None])
            a = known[a]
            q, s, i = np.concatenate([q, a]), np.concatenate([s, self.scores[a, w, b]]), np.concatenate([i, self.ids[a, w, b]])
            order = np.lexsort((i, -s, q))
            q, s, i = q[order], s[order], i[order]
            place = _places(q)
            first = place < self.k
            q, s, i, place = q[first], s[first], i[first], place[first]
            self.scores[q, w, place], self.ids[q, w, place] = s, i
            self.filled[known, w] = np.bincount(q, minlength=len(self.queries))[known]
            full = known[self.filled[known, w] == self.k]
            self.floors[full, w] = np.maximum(self.floors[full, w], self.scores[full, w, self.k - 1])


def index(rows: DataFrame) -> DataFrame:
    """A written table of cover trees of ``rows`` (vec_id, label, v): shard, tree. Every row is in one."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("")
        held: dict[int, list[tuple]] = {}

        def tree(dim: int) -> pd.DataFrame:
            ids, labels, vectors = zip(*held.pop(dim))
            made = CoverTree.grow(np.array(ids, np.int64), np.array(labels, np.int64), np.stack(vectors).reshape(len(ids), dim))
            return pd.DataFrame({"tree": [_pack(**made)]})

        for batch in batches:
            for row in zip(batch["vec_id"], batch["label"], batch["v"]):
                dim = len(row[2])
                held.setdefault(dim, []).append(row)
                if len(held[dim]) == SHARD:
                    yield tree(dim)
        for dim in list(held):
            yield tree(dim)

    built = rows.mapInPandas(build, "tree binary")
    return materialize(built.select(F.monotonically_increasing_id().alias("shard"), "tree"), "cover_trees")


def _blocks(anchors: DataFrame) -> DataFrame:
    """Anchors (anchor, vec_id, label, v, lows, highs) packed in blocks, one row each."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims = batch["v"].map(len)
            for dim in sorted(dims.unique()):
                whole = batch[dims == dim]
                for at in range(0, len(whole), BLOCK):
                    some = whole.iloc[at : at + BLOCK]
                    sizes = some["lows"].map(len).to_numpy(np.int64)
                    flat = lambda c: np.concatenate([np.asarray(x, np.float64) for x in some[c]])  # noqa: E731, B023
                    own = {c: some[c].to_numpy(np.int64) for c in ("anchor", "vec_id", "label")}
                    yield pd.DataFrame({"block": [_pack(**own, v=np.stack(some["v"]).reshape(len(some), dim), sizes=sizes, lows=flat("lows"), highs=flat("highs"))]})

    return materialize(anchors.mapInPandas(pack, "block binary"), "anchors")


def dealt(trees: DataFrame, blocks: DataFrame) -> DataFrame:
    """What meets in a task, trees first: kind (0 is a tree, 1 a block of anchors), data."""
    spark = trees.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = sorted(r["shard"] for r in trees.select("shard").collect())  # one number for SHARD rows
    bins = max(1, -(-len(shards) // BIN), min(len(shards), parts))
    pieces = max(1, parts // (BIN * bins))
    number = spark.createDataFrame([(shard, n % bins) for n, shard in enumerate(shards)], "shard long, bin int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    to_bin = trees.join(number.hint("broadcast"), "shard").select("bin", every(pieces).alias("piece"), F.lit(0).alias("kind"), F.col("tree").alias("data"))
    blocks = blocks.withColumn("piece", F.pmod(F.xxhash64("block"), F.lit(pieces)).cast("int"))
    copies = blocks.select(every(bins).alias("bin"), "piece", F.lit(1).alias("kind"), F.col("block").alias("data"))
    task = F.col("bin") * pieces + F.col("piece")
    return to_bin.unionByName(copies).repartitionById(bins * pieces, task).sortWithinPartitions("kind").select("kind", "data")


def search(trees: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """The first ``k`` rows in each window of each anchor: anchor, window (from 0), id, score, place (from 1).

    ``trees`` is what ``index`` made. ``anchors`` has anchor (a number of its own), vec_id, label, v, and the arrays lows and highs.
    """
    met = dealt(trees, _blocks(anchors))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("")
        held = []
        for batch in batches:
            for kind, data in zip(batch["kind"], batch["data"]):
                if kind == 0:
                    held.append(CoverTree(_unpack(data)))
                    continue
                block = _unpack(data)
                sizes = block["sizes"]
                windows = np.arange(max(1, sizes.max())) < sizes[:, None]
                lows, highs = np.full(windows.shape, np.inf), np.full(windows.shape, -np.inf)
                lows[windows], highs[windows] = block["lows"], block["highs"]
                asked = Asked(block["v"].astype(np.float64), block["vec_id"], block["label"], same, lows, highs, k)
                for tree in held:
                    if tree.points.shape[1] == asked.queries.shape[1]:
                        tree.answer(asked)
                q, w, at = np.nonzero(np.arange(k) < asked.filled[:, :, None])
                yield pd.DataFrame({"anchor": block["anchor"][q], "window": w.astype(np.int32), "id": asked.ids[q, w, at], "score": asked.scores[q, w, at].astype(np.int64)})

    found = met.mapInPandas(answer, "anchor long, window int, id long, score long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` is what ``candidates`` gives. The positives of an anchor are its first other rows of its label. A negative
    is a row of another label whose score is ``low`` to ``high`` percent of the positive's.
    """
    rows = materialize(rows, "candidates")
    trees = index(rows)
    anchors = materialize(rows.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "queries")
    everything = [F.array(F.lit(x)).alias(name) for name, x in (("lows", float("-inf")), ("highs", float("inf")))]
    found = search(trees, anchors.select("*", *everything), True, positives)
    found = materialize(found.select("anchor", F.col("place").alias("p"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # low * p <= 100 * n <= high * p: with integers the least and the greatest n.
    down = lambda x: (x - F.pmod(x, F.lit(100))) / 100  # noqa: E731  exact: a multiple of 100, far below 2**53
    least, most = -down(-low * F.col("positive_score")), down(high * F.col("positive_score"))
    windows = found.select("anchor", "p", least.cast("double").alias("low"), most.cast("double").alias("high")).filter("low <= high")
    listed = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("p", "low", "high"))).alias("w"))
    asked = anchors.join(listed, "anchor").select("anchor", "vec_id", "label", "v", F.col("w.p").alias("ps"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    asked = materialize(asked, "windows")
    near = search(trees, asked.drop("ps"), False, negatives)
    named = near.join(asked.select("anchor", F.col("vec_id").alias("anchor_id"), "ps"), "anchor")
    named = named.select("anchor", "anchor_id", F.get("ps", F.col("window")).alias("p"), F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(found, ["anchor", "p"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
