"""Language identification by the nearest of several centroids per language.

A text is the vector of its byte n-grams (1 to 3 bytes of its lower-case letters, other
characters as one space), hashed to ``DIMENSIONS`` slots, weighted by log counts and inverse
document frequency, and normalised. Document frequencies are counted over all labelled
rows. Centroids are found by spherical k-means within each language, on a bounded sample:
about ``SAMPLE`` rows a language, chosen by hash. A text takes the language of the centroid
with the largest cosine. It is marked as rejected if that cosine stays below ``REJECT`` times the
``LOW`` quantile of the cosines of the ``NEAR`` sample texts of that language that are nearest in length,
each measured without its own share in its centroid: cosines grow with length, and a few odd or
mislabelled rows do not move a quantile. Below the lengths of the sample it falls with the root of the length.

Nulls, empty texts: a null text or one without a letter is ``und`` with score 0 and rejected;
rows without a label are not learned from; without any labelled row everything is
``und``. Equal cosines go to the first language in order. Rows are returned once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.llm.caches import claim
from payfeed.llm.rows import with_fields

UNKNOWN = "und"
DIMENSIONS = 4096
SAMPLE = 2000
CENTROIDS = 4
REJECT = 0.6
LOW, NEAR = 0.01, 300
KNOTS = np.arange(2, 15)  # lengths in letters (bytes) as logarithms to base 2
ROUNDS = 12
_ROWS = 256
_TO_SPACE = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class LanguageModel:
    """Centroids (rows), their languages and these' low cosines at ``KNOTS``, and the weights of slots."""

    languages: list[str]
    centroids: np.ndarray
    low: np.ndarray
    weights: np.ndarray


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def slot_counts(text: str | None) -> np.ndarray:
    """n-gram counts of a whole text by slot."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_TO_SPACE).split()
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    two = data[:-1] << np.uint32(8) | data[1:]
    three = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    grams = np.concatenate([data, two | np.uint32(1 << 24), three | np.uint32(1 << 25)])
    grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x9E3779B1)
    return np.bincount(grams >> np.uint32(32 - DIMENSIONS.bit_length() + 1), minlength=DIMENSIONS)


def measured(texts: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of texts, and the logarithms of their lengths."""
    out, length = np.zeros((len(texts), DIMENSIONS), np.float32), np.zeros(len(texts))
    for i, text in enumerate(texts):
        counts = slot_counts(text)
        out[i], length[i] = np.log1p(counts) * weights, np.log2(counts.sum() / 3 + 1)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9), length


def vectors(texts: list, weights: np.ndarray) -> np.ndarray:
    return measured(texts, weights)[0]


def cosines_without_own(points: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Each point's cosine with the nearest centroid, its own taken without the point."""
    sums = np.zeros((mine.max() + 1, points.shape[1]))
    np.add.at(sums, mine, points)
    dots, norms, at = points @ sums.T, np.linalg.norm(sums, axis=1), np.arange(len(points))
    own = dots[at, mine]
    rest = np.sqrt(np.maximum(norms[mine] ** 2 - 2 * own + 1, 0))
    cosine = dots / np.maximum(norms, 1e-9)
    cosine[at, mine] = np.where(np.bincount(mine)[mine] > 1, (own - 1) / np.maximum(rest, 1e-9), 0)
    return cosine.max(1)


def low_cosines(cosine: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The low quantile of cosines at ``KNOTS``."""
    out = []
    for knot in KNOTS:
        near = np.argsort(np.abs(length - knot), kind="stable")[:NEAR]
        out.append(np.quantile(cosine[near], LOW) * min(1.0, 2 ** ((knot - length[near].min()) / 2)))
    return np.array(out)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each slot occurs, and how many texts there are."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("features")
        found, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found += slot_counts(text) > 0
                n += 1
        yield pd.DataFrame({"slot": np.arange(-1, DIMENSIONS), "n": np.concatenate([[n], found])})

    rows = texts.select("text").mapInPandas(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    got = dict(zip(rows["slot"], rows["n"]))  # DIMENSIONS + 1 rows
    return np.array([got.get(i, 0) for i in range(DIMENSIONS)], np.int64), int(got.get(-1, 0))


def spherical_means(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and each point's centroid; starts from points far from those before."""
    centres = [points.mean(0)]
    near = points @ centres[0]
    for _ in range(1, min(count, len(points))):
        centres.append(points[int(np.argmin(near))])
        near = np.maximum(near, points @ centres[-1])
    centre = np.array(centres)
    for _ in range(ROUNDS):
        centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
        mine = np.argmax(points @ centre.T, axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, mine, points)
        centre = np.where(np.bincount(mine, minlength=len(centre))[:, None] > 0, sums, centre)
    centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
    return centre, np.argmax(points @ centre.T, axis=1)


def train(labelled: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> LanguageModel:
    """Learn from ``text`` and non-null ``lang``; a text without a letter teaches nothing."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null").filter(F.col("text").rlike(r"\p{L}"))
    frequency, n = document_frequencies(rows)
    weights = (np.log((n + 1) / (frequency + 1)) + 0.1).astype(np.float32)
    share = rows.groupBy("lang").agg((F.lit(sample) / F.count(F.lit(1))).alias("share"))
    spread = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Languages are few; should labels be many, the join is left to the planner.
    few = share.limit(sample + 1).count() <= sample
    chosen = rows.join(F.broadcast(share) if few else share, "lang").filter(spread < F.col("share")).select("lang", "text").distinct()

    def cluster(key, group):
        texts = sorted(group["text"])
        points, length = measured(texts, weights)
        centre, mine = spherical_means(points, centroids)
        # A centroid of a few odd texts would take in whatever is as odd.
        held = np.bincount(mine, minlength=len(centre))
        centre = centre[held >= min(LOW * len(points), held.max())]
        mine = np.argmax(points @ centre.T, axis=1)
        low = low_cosines(cosines_without_own(points, mine), length)
        keep = np.unique(mine)
        return pd.DataFrame({
            "lang": key[0],
            "number": keep.astype(np.int32),
            "centre": [centre[k].astype("<f4").tobytes() for k in keep],
            "low": [low.tolist() for _ in keep],
        })

    found = chosen.groupBy("lang").applyInPandas(cluster, "lang string, number int, centre binary, low array<double>").toPandas()
    found = found.sort_values(["lang", "number"])
    centre = np.array([np.frombuffer(c, "<f4") for c in found["centre"]], np.float32).reshape(-1, DIMENSIONS)
    return LanguageModel(found["lang"].tolist(), centre, np.array(found["low"].tolist(), float).reshape(-1, len(KNOTS)), weights)


def predict(docs: DataFrame, model: LanguageModel, columns: list[str], reject: float = REJECT) -> DataFrame:
    """``columns`` of ``docs`` with lang_pred, score (cosine, 0 to 1) and rejected.

    A rejected text with letters keeps its nearest language in lang_pred.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*columns, F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("languages")
        m = known.value
        for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
            texts = batch.column("_text").to_pylist()
            names, scores, refused = [], [], []
            for at in range(0, len(texts), _ROWS):
                some = texts[at : at + _ROWS]
                if not len(m.languages):
                    names, scores, refused = names + [UNKNOWN] * len(some), scores + [0.0] * len(some), refused + [True] * len(some)
                    continue
                points, length = measured(some, m.weights)
                cosine = points @ m.centroids.T
                best = np.argmax(cosine, axis=1)
                for i, text in enumerate(some):
                    good = has_letter(text)
                    value = float(min(1.0, max(0.0, cosine[i, best[i]]))) if good else 0.0
                    names.append(m.languages[best[i]] if good else UNKNOWN)
                    scores.append(value)
                    refused.append(not good or value < reject * np.interp(length[i], KNOTS, m.low[best[i]]))
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(refused, pa.bool_())], names=[*columns, "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, with_fields(rows.select(*columns).schema, "lang_pred string, score double, rejected boolean"))


def held_out() -> F.Column:
    """A fifth of the documents by a checksum of their id, kept from training."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
