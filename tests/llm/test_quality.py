"""Quality rules against brute force; sketches that merge; groups of their own."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from payfeed.llm import quality


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \n\t", "one", "a b c d e", "a b c d e f a b c d e", "x " * 50, "a\nb\na\n\n \n a", "a\r\nb\r\na\r\n",
    "## $5 & <b> | 100%", "éè \U0001f600 word same line", "a\x0bb\x0cc", "\n".join(["the same line again here"] * 4), "w" * 100_000,
    " ".join(str(i % 700) for i in range(20_000)),
]


def test_counts(make_docs):
    rng = random.Random(5)
    made = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) + rng.choice(["", "\n", "\nx\nx"]) for _ in range(120)]
    rows = list(enumerate(TEXTS + made)) + [(None, "a b"), (3, "one"), (3, "one")]
    got = quality.measure(make_docs(rows)).select("row.doc_id", *quality.COUNTS).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *counts(t)) for i, t in rows)


def fence(values, rule):
    """What the sketch must give, from all values of a group."""

    def step(v):
        return 1 << max(0, v.bit_length() - quality.BITS)

    buckets = sorted(v - v % step(v) for v in values)
    q10, q50, q90 = (buckets[-(-p * len(buckets) // 10) - 1] for p in (1, 5, 9))
    top = q90 + step(q90) - 1
    low = q10 - quality.REACH * (q50 + step(q50) - 1 - q10) - rule.slack
    return low if rule.low else None, top + quality.REACH * (top - q50) + rule.slack


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(9)
    rows = []
    for i in range(700):
        lang, source = rng.choice([("en", "hot"), ("en", "hot"), ("en", "cold"), (None, "hot"), ("de", None), ("de", "small")])
        size = 4 if lang == "en" else 9
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, size * 2))) for _ in range(rng.randint(5, 60))]
        if rng.random() < 0.05:
            words += ["$%&"] * 40
        rows.append(Row(doc_id=i, text=" ".join(words), lang=lang, source=source if rng.random() > 0.02 else f"rare{i}", n_words="clash"))
    rows += [Row(doc_id=None, text=None, lang="en", source="hot", n_words="clash"), rows[0], rows[0]]
    schema = "doc_id long, text string, lang string, source string, n_words string"
    return rows, spark.createDataFrame(rows, schema)


def expected(rows):
    groups, known = Counter(), []
    values: dict = {}
    for r in rows:
        c = dict(zip(quality.COUNTS, counts(r.text)))
        ratios = {x.name: x.scale * c[x.part] // c[x.whole] for x in quality.RULES} if c["n_words"] else None
        known.append((r, c, ratios))
        if ratios:
            for key in ((r.lang, r.source), (r.lang,), ()):
                groups[key] += 1
                for name, v in ratios.items():
                    values.setdefault((key, name), []).append(v)
    out = Counter()
    for r, c, ratios in known:
        bad = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        kept = not bad
        for rule in quality.RULES if ratios else []:
            key = next(k for k in ((r.lang, r.source), (r.lang,), ()) if not k or groups[k] >= quality.MIN_ROWS)
            low, high = fence(values[key, rule.name], rule)
            kept &= ratios[rule.name] <= high and (low is None or ratios[rule.name] >= low)
        out[r.doc_id, bad, kept] += 1
    return out


def test_verdicts(mixed):
    rows, docs = mixed
    got = quality.judge(docs)
    assert Counter((r[0], r[1], r[2]) for r in got.select("row.doc_id", "base_failed", "kept").collect()) == expected(rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.n_words for r in kept.collect()} == {"clash"}
    assert 300 < kept.count() < len(rows)


def test_sketches_merge(mixed):
    _, docs = mixed
    whole = quality.sketch(quality.measure(docs))
    halves = [quality.sketch(quality.measure(docs.filter(f"coalesce(doc_id, 0) % 2 = {k}"))) for k in (0, 1)]
    assert Counter(quality.merge(*halves).collect()) == Counter(whole.collect())
    assert Counter(quality.thresholds(quality.merge(*halves)).collect()) == Counter(quality.thresholds(whole).collect())


def test_quantiles_are_close(spark):
    rng = random.Random(2)
    values = sorted(int(rng.lognormvariate(8, 2)) for _ in range(5000))
    rows = spark.createDataFrame([Row(row=Row(lang="x", source="y"), n_words=v, word_chars=1, n_symbols=0) for v in values])
    rule = quality.Rule("v", "n_words", "word_chars", 1, 0)
    (q,) = quality.quantiles(quality.sketch(rows.filter("n_words > 0"), [rule]), ["lang"], {"q10": 0.1, "q50": 0.5, "q90": 0.9}).collect()
    values = [v for v in values if v > 0]
    for p, got in ((1, q.q10), (5, q.q50), (9, q.q90)):
        true = values[-(-p * len(values) // 10) - 1]
        assert got <= true < got * (1 + 2 ** (1 - quality.BITS)) + 1


def test_earlier_sketch_counts(spark, mixed):
    _, docs = mixed
    earlier = quality.sketch(quality.measure(docs))
    few = docs.limit(20)
    got = quality.judge(few, earlier).select("symbols_high", "row.lang", "row.source").distinct()
    assert got.filter("symbols_high IS NULL").isEmpty()


def test_empty_and_plain_columns(spark, make_docs):
    assert quality.judge(make_docs([])).count() == 0
    df = spark.range(0).select(F.col("id").alias("a.b"), F.lit("x").alias("text"), F.lit("x").alias("lang"), F.lit(1).alias("source"))
    assert quality.keep_good(df).columns == ["a.b", "text", "lang", "source"]


def test_no_python(spark, sf_dir):
    from payfeed.llm.queries import QUERIES

    plan = QUERIES["op11_quality_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
