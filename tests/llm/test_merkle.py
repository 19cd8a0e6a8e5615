"""Merkle manifest against plain Python; positions against a walk; proofs that fail where they must."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from payfeed.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)])
    return levels


def postorder(n):
    """(level, index) of all nodes as they become complete."""
    top = len(levels_of(["x"] * n)) - 1
    out = []

    def walk(level, index):
        if level:
            for child in range(8 * index, min(8 * index + 8, -(-n // 8 ** (level - 1)))):
                walk(level - 1, child)
        out.append((level, index))

    walk(top, 0)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 72, 73, 512, 513, 600, 4097])
def test_positions(n):
    order = postorder(n)
    assert [merkle.position(level, index, n) for level, index in order] == list(range(len(order)))
    assert merkle.height(n) == order[-1][0]


def made(spark, sizes):
    rows = [Row(doc_id=(i * 7919) % 100_003 if i else None, lang=lang, text=f"t {lang} {i}", leaf="clash", index=i) for lang, n in sizes.items() for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, lang string, text string, leaf string, index int")


def leaf_of(r):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*map(part, (r.doc_id, r.lang, r.text)))


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {lang: levels_of([x[2] for x in sorted(trees[lang])]) for lang in langs}
    top = levels_of([built[lang][-1][0] for lang in langs])

    def path(levels, i):
        out = []
        for nodes in levels[:-1]:
            run = list(range(8 * (i // 8), min(8 * (i // 8) + 8, len(nodes))))
            out += [nodes[k] for k in run if k != i]
            i //= 8
        return out

    out = Counter()
    for t, lang in enumerate(langs):
        for i, leaf in enumerate(built[lang][0]):
            out[leaf, built[lang][-1][0], top[-1][0], "".join(path(built[lang], i) + path(top, t))] += 1
    return out, built, langs


SIZES = {"en": 700, None: 65, "de": 1, "fr": 8, "": 513, "zz": 64, "é": 3, "Z": 2, "a": 1, "b": 1}


@pytest.mark.parametrize("tier", [1, 2, 4])
def test_proofs_and_log(spark, monkeypatch, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    rows, docs = made(spark, SIZES)
    rows += rows[10:14]
    docs = docs.union(docs.filter("index BETWEEN 10 AND 13 AND lang = 'en'"))
    fields = [F.col("doc_id"), F.col("lang"), F.col("text")]
    m = merkle.build(docs.withColumn("digest", merkle.leaf(fields)), "lang", ["doc_id"], "digest")
    found = merkle.prove(m).withColumn("folded", merkle.fold(F.col("leaf"), F.col("places"), F.col("siblings")))
    got = found.select("leaf", "subroot", "root", F.array_join("siblings", "").alias("s"), "folded", "row.leaf").collect()
    want, built, langs = expected(rows)
    assert Counter(tuple(r)[:4] for r in got) == want
    assert all(r.folded == r.root for r in got) and {r[5] for r in got} == {"clash"}
    for tree, lang in enumerate(langs):
        log = m.log.filter(F.col("tree") == tree).orderBy("position").collect()
        order = postorder(len(built[lang][0]))
        assert [(r["level"], r["index"], r["digest"]) for r in log] == [(a, b, built[lang][a][b]) for a, b in order]
        assert [r.position for r in log] == list(range(len(order)))


def test_some_leaves_only_and_tampering(spark):
    _, docs = made(spark, {"en": 100, "de": 20})
    fields = [F.col("doc_id"), F.col("lang"), F.col("text")]
    m = merkle.build(docs.withColumn("digest", merkle.leaf(fields)), "lang", ["doc_id"], "digest")
    found = merkle.prove(m, m.leaves.filter("row.index % 10 = 3"))
    other = merkle.fold(F.sha2(F.lit("forged"), 256), F.col("places"), F.col("siblings"))
    moved = merkle.fold(F.col("leaf"), F.transform("places", lambda p: (p + 1) % 2), F.col("siblings"))
    got = found.select((other == F.col("root")).alias("a"), (moved == F.col("root")).alias("b")).collect()
    assert len(got) == 12 and not any(r.a or r.b for r in got)


def test_field(spark):
    df = spark.createDataFrame([Row(a="é", b=None, c=12)], "a string, b string, c long")
    assert df.select(*[merkle.field(F.col(c)) for c in "abc"]).first() == ("2:é", "-", "2:12")


def test_empty(spark):
    _, docs = made(spark, {"en": 1})
    m = merkle.build(docs.filter("false"), "lang", ["doc_id"])
    assert merkle.prove(m).count() == 0 and m.log.count() == 0
