r"""Quality rules with thresholds from the data, in DataFrame operations alone.

``measure`` counts words, symbols, repeated lines and repeated windows of each text. ``sketch``
folds the ratios of all documents into quantile sketches per language and source. A sketch
is a histogram whose buckets keep the ``BITS`` leading bits of a value, so a quantile is
off by less than one part in 2**(BITS-1), whatever the distribution. Sketches merge by adding
counts (``merge``): those of earlier days or of other clusters may be added to today's, and the
sketch of a language is the sum of its sources' sketches. They are the same in whatever order rows
come, so a repeated task gives the same thresholds.

``thresholds`` puts fences around each group's own middle: a ratio above the 90th percentile by more than
``REACH`` times its distance from the median (and the rule's ``slack``) is too high; too low likewise. A group of
fewer than ``MIN_ROWS`` documents takes the fences of its language, a language of fewer those of all documents.
``judge`` joins the fences to the documents.

Hot groups: documents are folded before they are shuffled, so a source with a third of all rows
sends a few hundred counts per task. Fences are one row per group; the join leaves it to
adaptive execution whether their measured size is broadcast or a hot group is split.

Nulls, empty texts, ties: a null or empty text has no words and fails the base rules; it is in no sketch, as
its ratios are undefined. A null language or source is a group of its own. Repeated rows count
each. An empty table gives an empty result. Other columns are carried along, and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payfeed.session import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = "#*$%&|<>"
BITS = 7
REACH = 3
MIN_ROWS = 100
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts, times ``scale``; ``slack`` is tolerated beyond what the quantiles give."""

    name: str
    part: str
    whole: str
    scale: int
    slack: int
    low: bool = False

    def value(self) -> Column:
        return F.expr(f"CASE WHEN n_words > 0 AND `{self.whole}` > 0 THEN {self.scale} * `{self.part}` DIV `{self.whole}` END")


RULES = [
    Rule("word_length", "word_chars", "n_words", 100, 150, low=True),
    Rule("symbols", "n_symbols", "word_chars", 10_000, 200),
    Rule("dup_lines", "n_dup_lines", "n_lines", 10_000, 3_500),
    Rule("repeats", "n_repeat_words", "n_words", 10_000, 500),
]


def _windows(words: Column, of) -> Column:
    """``of`` the words of each window, at its place; empty where the text is shorter."""
    places = F.sequence(F.lit(0), F.size(words) - REPEAT_WINDOW)
    made = F.transform(places, lambda i: of([words[i + k] for k in range(REPEAT_WINDOW)], i))
    return F.when(F.size(words) >= REPEAT_WINDOW, made)


def _repeated_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words to rows with ``_words``.

    Texts whose windows all have different hashes have none, which settles most; the others
    compare the windows themselves, sorted with their places.
    """
    hashes = _windows(F.col("_words"), lambda words, _: F.xxhash64(*words))
    df = df.withColumn("_hashes", hashes)
    df = df.withColumn("_some", F.coalesce(F.size("_hashes") > F.size(F.array_distinct("_hashes")), F.lit(False))).drop("_hashes")
    named = _windows(F.col("_words"), lambda words, i: F.struct(F.concat_ws(" ", *words).alias("w"), i.alias("i")))
    df = df.withColumn("_sorted", F.when(F.col("_some"), F.sort_array(named)))
    again = lambda x, k: ((k > 0) & (F.get("_sorted", k - 1)["w"] == x["w"])) | (F.get("_sorted", k + 1)["w"] == x["w"])
    covered = F.flatten(F.transform(F.col("_again"), lambda x: F.array(*[x["i"] + k for k in range(REPEAT_WINDOW)])))
    df = df.withColumn("_again", F.filter("_sorted", lambda x, k: F.coalesce(again(x, k), F.lit(False))))
    count = F.when(F.col("_some"), F.size(F.array_distinct(covered))).otherwise(0)
    return df.withColumn("n_repeat_words", count.cast("long")).drop("_some", "_sorted", "_again")


def measure(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    r"""``carry`` of the rows of ``docs`` (all columns by default) as a struct ``row``, with the counts of their ``text`` as longs beside it.

    Words are ``[^\x20\x09-\x0D]+``. word_chars are code points in words; n_symbols characters of ``SYMBOLS``; n_lines lines (cut at
    ``\n``) with a word, n_dup_lines those equal to an earlier one; n_repeat_words words in five-word windows that the text has twice or more.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row"), text.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = rows.select("row", "_text", F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), "").alias("_words"), lines.alias("_lines"))
    df = df.select(
        "row",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    return _repeated_words(df).select("row", *COUNTS)


def base_failed() -> Column:
    """Too short, or too many of its words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _step(value: Column) -> Column:
    """Width of the bucket of a value."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(value)) - BITS, F.lit(0)))


def sketch(measured: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per language, source, rule and bucket: lang, source, rule, bucket (its least value), n."""
    values = F.array(*[F.struct(F.lit(r.name).alias("rule"), r.value().alias("value")) for r in rules])
    long = measured.select(F.col("row.lang").cast("string").alias("lang"), F.col("row.source").cast("string").alias("source"), F.inline(values)).filter("value IS NOT NULL")
    bucket = F.col("value") - F.col("value") % _step(F.col("value"))
    return long.groupBy("lang", "source", "rule", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge(*sketches: DataFrame) -> DataFrame:
    """The sketch of all documents that are in any of ``sketches``."""
    together = reduce(DataFrame.unionByName, sketches)
    return together.groupBy("lang", "source", "rule", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketched: DataFrame, groups: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Per group and rule: n, and the bucket in which each of the named quantiles lies, by its least value."""
    whole = sketched.groupBy(*groups, "rule", "bucket").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*groups, "rule")
    up_to = by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    placed = whole.withColumn("upto", F.sum("n").over(up_to)).withColumn("total", F.sum("n").over(by))
    # Quantile p is the value of the row with number ceil(p * total), from 1; thousandths keep it whole.
    found = {q: F.min(F.when(F.col("upto") * 1000 >= F.col("total") * round(1000 * p), F.col("bucket"))) for q, p in probabilities.items()}
    return placed.groupBy(*groups, "rule").agg(F.max("total").alias("n"), *[c.alias(q) for q, c in found.items()])


def thresholds(sketched: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Fences per language and source: lang, source, and ``<rule>_high`` (and ``<rule>_low``) of each rule.

    ``sketched`` is read once for each of three levels and should be a written table.
    """

    def fences(groups: list[str], level: str) -> DataFrame:
        q = quantiles(sketched, groups, {"q10": 0.1, "q50": 0.5, "q90": 0.9})
        slack = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.slack)])[F.col("rule")]
        top = F.col("q90") + _step(F.col("q90")) - 1
        high = top + REACH * (top - F.col("q50")) + slack
        low = F.col("q10") - REACH * (F.col("q50") + _step(F.col("q50")) - 1 - F.col("q10")) - slack
        fence = F.when(F.col("n") >= MIN_ROWS if groups else F.lit(True), F.struct(low.alias("low"), high.alias("high")))
        return q.select(*[F.col(g).alias(f"{level}_{g}") for g in groups], F.col("rule").alias(f"{level}_rule"), fence.alias(f"{level}_fence"))

    same = lambda level, names: reduce(lambda a, b: a & b, [F.col(f"s_{n}").eqNullSafe(F.col(f"{level}_{n}")) for n in names])
    own = fences(["lang", "source"], "s")
    joined = own.join(fences(["lang"], "l"), same("l", ["lang", "rule"])).join(fences([], "a"), same("a", ["rule"]))
    fence = F.coalesce("s_fence", "l_fence", "a_fence")
    sides = [(f"{r.name}_{side}", r.name, side) for r in rules for side in (("low", "high") if r.low else ("high",))]
    wide = [F.max(F.when(F.col("s_rule") == rule, fence[side])).alias(name) for name, rule, side in sides]
    return joined.groupBy(F.col("s_lang").alias("lang"), F.col("s_source").alias("source")).agg(*wide)


def judge(docs: DataFrame, earlier: DataFrame | None = None, rules: list[Rule] = RULES, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the document as it came, or its columns ``carry``, with lang and source), its counts, base_failed, each rule's ratio and fences, and kept.

    ``docs`` has text, lang and source. ``earlier`` is a sketch of documents judged before, merged
    with that of ``docs``. Texts are measured once; the measured rows are a written table.
    """
    measured = materialize(measure(docs, carry), "measured")
    sketched = sketch(measured, rules)
    sketched = materialize(merge(sketched, earlier) if earlier is not None else sketched, "sketch")
    limits = materialize(thresholds(sketched, rules), "thresholds")
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    on = F.col("row.lang").cast("string").eqNullSafe(F.col("_lang")) & F.col("row.source").cast("string").eqNullSafe(F.col("_source"))
    joined = measured.join(limits, on, "left").drop("_lang", "_source").withColumns({r.name: r.value() for r in rules} | {"base_failed": base_failed()})
    inside = [F.col(r.name) <= F.col(f"{r.name}_high") for r in rules] + [F.col(r.name) >= F.col(f"{r.name}_low") for r in rules if r.low]
    kept = ~F.col("base_failed") & reduce(lambda a, b: a & b, [F.coalesce(x, F.lit(True)) for x in inside])
    return joined.withColumn("kept", kept)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they came."""
    return judge(docs).filter("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
