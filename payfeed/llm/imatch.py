"""Document fingerprints by I-Match over randomised lexicons, in DataFrame operations alone.

Terms are counted over all documents, and the lexicon keeps those whose inverse document
frequency lies in a band. A document is the sorted list of its distinct lexicon terms. Of the lexicon,
``SEEDS`` x ``LEVELS`` random subsets are drawn, level l with a share of 2**-l of the terms,
and the list of a document's terms in each subset is hashed: similar documents agree in subsets
that miss their differences. A fingerprint is the hashes of all subsets, and the
likeness of two is the share of equal ones among those that are not empty in both.

The lexicon is broadcast. A term of it occurs in at least ``RARE`` of all documents, so it has at
most (distinct terms of an average document) / ``RARE`` entries of 24 bytes, whatever the number
of documents.

``compare_with_edits`` also needs each document's successor in descending doc_id. Ids are cut
into ranges of about equal counts; each range is a partition of a window, and also gets
a copy of the first document of the range that follows. Texts are shuffled once; all steps
after that keep their partitioning.

Nulls, empty texts, ties: a null text is empty; a text without lexicon terms is fingerprinted by
a hash of the text itself; null doc_ids come last; rows that repeat a doc_id follow each
other in the order of their text hashes. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payfeed.session import materialize

# Band of document frequency as shares of all documents: idf from ln(10) to ln(2000).
RARE, COMMON = 1 / 2000, 1 / 10
SEEDS, LEVELS = 8, 12


def distinct_terms(text: Column) -> Column:
    """Distinct lower-case terms of a text."""
    return F.array_distinct(F.split(F.lower(text), r"[\s\p{Punct}]+"))


def lexicon(docs: DataFrame, rare: float = RARE, common: float = COMMON) -> DataFrame:
    """Terms (hashed) inside the band, with their levels in each seed's subsets.

    ``levels`` packs four bits a seed: the term is in that seed's subsets up to this level.
    """
    terms = docs.select(F.explode(distinct_terms(F.col("text"))).alias("word")).filter("word != ''")
    counted = terms.select(F.xxhash64("word").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = docs.count()
    band = counted.filter((F.col("df") >= rare * total) & (F.col("df") <= F.greatest(F.lit(1.0), F.lit(common * total)))).select("term")
    levels = F.lit(0).cast("long")
    for seed in range(SEEDS):
        # The number of leading zeros of a hash is at least l with probability 2**-l.
        zeros = 64 - F.length(F.bin(F.xxhash64("term", F.lit(seed))))
        levels = levels + F.shiftleft(F.least(zeros, F.lit(LEVELS)).cast("long"), 4 * seed)
    return materialize(band.withColumn("levels", levels), "lexicon")


def subset_hashes(terms: DataFrame, source: str, target: str, keep: list[str]) -> DataFrame:
    """From sorted lists of (term, levels) in ``source`` an array of a hash per subset, null where empty."""
    out, hashes = terms.withColumns({f"_l{s}": F.col(source) for s in range(SEEDS)}), []
    for level in range(1, LEVELS + 1):
        # Subsets of a seed are nested, so each level filters the one before.
        out = out.withColumns({
            f"_l{s}": F.filter(f"_l{s}", _in_subset(s, level)) for s in range(SEEDS)
        })
        made = {f"_h{s}_{level}": F.when(F.size(f"_l{s}") > 0, F.xxhash64(F.transform(f"_l{s}", lambda t: t["term"]))) for s in range(SEEDS)}
        out = out.withColumns(made)
        hashes += made
    return out.select(*keep, F.array(*hashes).alias(target))


def _in_subset(seed: int, level: int):
    return lambda term: F.shiftright(term["levels"], 4 * seed).bitwiseAND(F.lit(15)) >= level


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among those not null in both."""
    both = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None)).otherwise(F.coalesce(x == y, F.lit(False)).cast("int")))
    used = F.filter(both, lambda v: v.isNotNull())
    return F.when(F.size(used) == 0, 0.0).otherwise(F.aggregate(used, F.lit(0), lambda s, v: s + v) / F.size(used))


def as_text(hashes: Column, whole: Column) -> Column:
    """Fingerprint as a string; ``whole`` is a hash of the text for those without lexicon terms."""
    digits = F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.lpad(F.hex(F.shiftrightunsigned(h, 32)), 8, "0")), F.lit("-"))), ".")
    empty = F.size(F.filter(hashes, lambda h: h.isNotNull())) == 0
    return F.when(empty, F.concat(F.lit("t"), F.lower(F.hex(whole)))).otherwise(digits)


def with_terms(rows: DataFrame, text: str, keys: list[str], words: DataFrame, carried: list[str]) -> DataFrame:
    """One row per ``keys`` with ``terms``, the sorted lexicon terms of ``text``. ``carried`` depend on the keys."""
    exploded = rows.select(*keys, *carried, F.explode_outer(distinct_terms(F.col(text))).alias("word"))
    hashed = exploded.select(*keys, *carried, F.xxhash64("word").alias("term"))
    found = hashed.join(F.broadcast(words), "term", "left")
    member = F.when(F.col("levels").isNotNull(), F.struct("term", "levels"))
    return found.groupBy(*keys).agg(*(F.first(c).alias(c) for c in carried), F.sort_array(F.collect_list(member)).alias("terms"))


def fingerprints(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` (which identify rows) of ``docs`` with the fingerprint of ``text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*columns, text.alias("text")).withColumn("_whole", F.xxhash64("text"))
    words = lexicon(rows)
    found = subset_hashes(with_terms(rows, "text", [*columns, "_whole"], words, []), "terms", "hashes", [*columns, "_whole"])
    return found.select(*columns, as_text(F.col("hashes"), F.col("_whole")).alias("fingerprint"))


def _ranges(docs: DataFrame) -> tuple[Column, list[tuple[int | None, int, int]]]:
    """A column with the range of a doc_id (higher ids first), and per range its largest id and the range before."""
    spark = docs.sparkSession
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    low, high, total = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    if not total:
        return F.lit(0), [(None, 0, 0)]
    cells = 8 * ranges
    width = (high - low) // cells + 1
    below = (F.lit(high).cast("decimal(20,0)") - F.col("doc_id").cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")
    cell = F.least(F.floor(below).cast("int"), F.lit(cells - 1))
    counts = {r["cell"]: r["n"] for r in docs.filter("doc_id is not null").groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    of_cell, done = [], 0
    for i in range(cells):
        of_cell.append(min(ranges - 1, done * ranges // total))
        done += counts.get(i, 0)
    at = F.coalesce(F.element_at(F.lit(of_cell), cell + 1), F.lit(ranges - 1))
    heads = docs.groupBy(at.alias("at")).agg(F.max("doc_id").alias("head")).orderBy("at").collect()  # a row a range
    found = [(r["head"], r["at"], heads[i - 1]["at"]) for i, r in enumerate(heads)]
    return at, found


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents, of their edited texts, and how like these and the next document are.

    The edited text has its last third replaced by the beginning of the next document in descending
    doc_id (after the last: the first). Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = lexicon(docs)
    at, heads = _ranges(docs)
    placed = docs.withColumn("at", at)
    # The first documents of a range also stand at the end of the range before.
    spark = docs.sparkSession
    guests = spark.createDataFrame([(h, b, t) for h, t, b in heads], "head long, before int, own int")
    guest = placed.join(F.broadcast(guests), (F.col("at") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head")))
    rows = placed.withColumn("guest", F.lit(False)).unionByName(guest.select("doc_id", "text", F.col("before").alias("at"), F.lit(True).alias("guest")))

    order = Window.partitionBy("at").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text")))
    rows = rows.withColumns({"pos": F.row_number().over(order), "following": F.lead("text").over(order)})
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.coalesce("following", F.lit("")), F.lit(1), third))
    rows = rows.select("at", "pos", "guest", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    versions = F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
    rows = rows.select("at", "pos", "guest", "doc_id", "n_chars", "edited_sha256", F.explode(versions).alias("version"))
    rows = rows.select("at", "pos", "guest", "doc_id", "n_chars", "edited_sha256", "version.kind", "version.text").filter("kind = 0 or not guest")
    rows = rows.withColumn("whole", F.xxhash64("text"))

    carried = ["guest", "doc_id", "n_chars", "edited_sha256", "whole"]
    listed = with_terms(rows, "text", ["at", "pos", "kind"], words, carried)
    hashed = subset_hashes(listed, "terms", "hashes", ["at", "pos", "kind", *carried])
    hashed = hashed.withColumn("print", as_text(F.col("hashes"), F.col("whole")))
    lined = Window.partitionBy("at").orderBy("pos", "kind")
    paired = hashed.withColumns({
        "edited_print": F.lead("print", 1).over(lined),
        "edited_hashes": F.lead("hashes", 1).over(lined),
        "next_print": F.lead("print", 2).over(lined),
        "next_hashes": F.lead("hashes", 2).over(lined),
    }).filter("kind = 0 and not guest")

    def near(prefix: str) -> Column:
        return F.when(F.col("print") == F.col(f"{prefix}_print"), 1.0).otherwise(likeness(F.col("hashes"), F.col(f"{prefix}_hashes")))

    return paired.select(
        "doc_id", "n_chars", "edited_sha256", F.col("print").alias("fingerprint"), F.col("edited_print").alias("edited_fingerprint"),
        near("edited").alias("near_edited"), near("next").alias("near_next"),
    )
