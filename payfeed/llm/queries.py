"""Registered queries of the subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payfeed.llm.files import reach_workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2,048 ids."""
    from payfeed.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to token files and read back."""
    from payfeed.llm.tokenfiles import token_documents

    return token_documents(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated windows."""
    from payfeed.llm.substrings import remove_repeats

    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from payfeed.llm.simhash import near_duplicate_groups

    return near_duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark phrases."""
    from payfeed.llm.decontaminate import find_phrases, n_hit

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_phrases(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("begins") > 0).alias("contaminated"),
    )


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    from payfeed.llm.language import held_out, predict, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out()))
    found = predict(docs, model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, normalised, and read back."""
    from payfeed.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages"))


@query
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from payfeed.llm.pagetext import default_model, extract

    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"], default_model())


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    from payfeed.llm.urls import judge

    return judge(table(spark, sf_dir, "pages"), ["page_id"])


_URL_PARTS = """
    SELECT page_id, host, CASE WHEN rest IS NULL THEN '' ELSE regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') END AS path
    FROM (
        SELECT page_id, rest, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host
        FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages)
    )
"""
_URL_RULES = "(VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS r(rule_host, rule_path, rule_verdict)"
_URL_WORDS = "adult|bet|bets|betting|casino|gambling|jackpot|pills|poker|porn|replica|sex|slots|viagra|warez|xxx"
ORACLES["op10_url_filter"] = f"""
    WITH parts AS (SELECT row_number() OVER () AS n, * FROM ({_URL_PARTS})),
    fits AS (
        SELECT n, rule_host || rule_path AS rule, rule_verdict,
               row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) AS place
        FROM parts JOIN {_URL_RULES}
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    )
    SELECT p.page_id, host, path, f.rule,
           CASE WHEN word = '' THEN NULL ELSE '*' || word || '*' END AS pattern,
           coalesce(rule_verdict, CASE WHEN word = '' THEN 'allow' ELSE 'block' END) AS verdict
    FROM (SELECT *, list_aggregate(list_append(list_sort(regexp_extract_all(regexp_replace(host, '([^a-z0-9])', '\\1\\1', 'g'), '(?:^|[^a-z0-9])({_URL_WORDS})(?:$|[^a-z0-9])', 1)), ''), 'first') AS word FROM parts) p
    LEFT JOIN (SELECT * FROM fits WHERE place = 1) f ON p.n = f.n
"""


@query
def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    from payfeed.llm.imatch import compare_with_edits

    return compare_with_edits(table(spark, sf_dir, "documents"))


ORACLES["op7_warc"] = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
    first AS (SELECT html, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY html)
    SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
           CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM p LEFT JOIN first USING (html)
"""

ORACLES["op3_substring_dedup"] = r"""
    WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM listed),
    windows AS (
        SELECT doc_id, pos, word,
               CASE WHEN count(*) OVER ahead = 35 THEN string_agg(word, ' ') OVER ahead END AS seq
        FROM placed WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
    ),
    counted AS (SELECT *, seq IS NOT NULL AND count(*) OVER (PARTITION BY seq) > 1 AS again FROM windows),
    covered AS (
        SELECT doc_id, pos, word,
               max(CAST(again AS INT)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
        FROM counted
    ),
    kept AS (
        SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
               coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0), '') AS text
        FROM covered GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM documents d LEFT JOIN kept USING (doc_id)
"""

_FOLDED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES["op5_decontamination"] = f"""
    WITH docs AS (SELECT doc_id, {_FOLDED} AS words FROM documents),
    items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_FOLDED} AS words FROM benchmark),
    starts AS (SELECT item_id, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS pos0 FROM items WHERE len(words) > 0),
    phrases AS (SELECT DISTINCT item_id, array_to_string(words[pos0:pos0 + 9], ' ') AS phrase, least(len(words), 10) AS size FROM starts),
    places AS (
        SELECT doc_id, words, size, unnest(generate_series(1, CAST(len(words) - size + 1 AS BIGINT))) AS pos0
        FROM docs, (SELECT DISTINCT size FROM phrases) s WHERE len(words) >= size
    ),
    found AS (
        SELECT doc_id, pos0, p.size, item_id FROM places
        JOIN phrases p ON p.size = places.size AND p.phrase = array_to_string(words[pos0:pos0 + places.size - 1], ' ')
    ),
    hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(generate_series(pos0, pos0 + size - 1)) AS pos FROM found) h GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) n GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and whether it stays inside the fences of its language and source."""
    from payfeed.llm.quality import RULES, judge

    found = judge(table(spark, sf_dir, "documents"), carry=["doc_id", "lang", "source"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, "base_failed", "kept", *[r.name for r in RULES])


_QUALITY_RULES = "(VALUES ('word_length', 150), ('symbols', 200), ('dup_lines', 3500), ('repeats', 500)) AS slack(rule, slack)"
_STEP = "(CAST(1 AS BIGINT) << greatest(length(bin({0})) - 7, 0))"


def _quality_fences(groups: str) -> str:
    """Fences of each rule in groups of the sketch."""
    by = f"{groups}, rule" if groups else "rule"
    return f"""
        SELECT {by}, n, q10 - 3 * (q50 + {_STEP.format("q50")} - 1 - q10) - slack AS low,
               q90 + {_STEP.format("q90")} - 1 + 3 * (q90 + {_STEP.format("q90")} - 1 - q50) + slack AS high
        FROM (
            SELECT {by}, max(total) AS n, min(bucket) FILTER (WHERE upto * 1000 >= total * 100) AS q10,
                   min(bucket) FILTER (WHERE upto * 1000 >= total * 500) AS q50, min(bucket) FILTER (WHERE upto * 1000 >= total * 900) AS q90
            FROM (
                SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER (PARTITION BY {by}) AS total
                FROM (SELECT {by}, bucket, sum(n) AS n FROM sketch GROUP BY {by}, bucket) AS whole
            ) AS placed GROUP BY {by}
        ) AS q JOIN {_QUALITY_RULES} USING (rule)
    """


ORACLES["op11_quality_rules"] = rf"""
    WITH rows AS (
        SELECT row_number() OVER () AS n_row, doc_id, lang, source, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ),
    placed AS (SELECT n_row, pos, array_to_string(words[pos:pos + 4], ' ') AS w FROM (SELECT n_row, words, unnest(generate_series(1, len(words) - 4)) AS pos FROM rows) AS r),
    again AS (SELECT n_row, pos FROM (SELECT *, count(*) OVER (PARTITION BY n_row, w) AS times FROM placed) AS p WHERE times > 1),
    repeats AS (SELECT n_row, count(DISTINCT covered) AS n_repeat_words FROM (SELECT n_row, unnest(generate_series(pos, pos + 4)) AS covered FROM again) AS a GROUP BY n_row),
    counts AS (
        SELECT n_row, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM rows LEFT JOIN repeats USING (n_row)
    ),
    ratios AS (
        SELECT *, CASE WHEN n_words > 0 THEN 100 * word_chars // n_words END AS word_length,
               CASE WHEN n_words > 0 THEN 10000 * n_symbols // word_chars END AS symbols,
               CASE WHEN n_words > 0 THEN 10000 * n_dup_lines // n_lines END AS dup_lines,
               CASE WHEN n_words > 0 THEN 10000 * n_repeat_words // n_words END AS repeats,
               n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
        FROM counts
    ),
    long AS (
        SELECT lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS rule, unnest([word_length, symbols, dup_lines, repeats]) AS value
        FROM ratios WHERE n_words > 0
    ),
    sketch AS (SELECT lang, source, rule, value - value % {_STEP.format("value")} AS bucket, count(*) AS n FROM long GROUP BY ALL),
    own AS ({_quality_fences("lang, source")}),
    by_lang AS ({_quality_fences("lang")}),
    by_all AS ({_quality_fences("")}),
    fences AS (
        SELECT o.lang, o.source, o.rule, CASE WHEN o.n >= 100 THEN o.low WHEN l.n >= 100 THEN l.low ELSE a.low END AS low,
               CASE WHEN o.n >= 100 THEN o.high WHEN l.n >= 100 THEN l.high ELSE a.high END AS high
        FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.rule = l.rule JOIN by_all a ON o.rule = a.rule
    ),
    checked AS (
        SELECT n_row, bool_or(CASE rule WHEN 'word_length' THEN word_length < low OR word_length > high WHEN 'symbols' THEN symbols > high
                                        WHEN 'dup_lines' THEN dup_lines > high ELSE repeats > high END) AS outside
        FROM ratios r JOIN fences f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source WHERE n_words > 0 GROUP BY n_row
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(outside, FALSE) AS kept,
           word_length, symbols, dup_lines, repeats
    FROM ratios LEFT JOIN checked USING (n_row)
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document, a third of them tampered with."""
    from payfeed.llm.merkle import build, fold, leaf, prove

    fields = ["doc_id", "source", "lang", "n_chars"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf([*map(F.col, fields), lowered]))
    docs = table(spark, sf_dir, "documents")
    found = prove(build(docs.select("doc_id", "lang", leaf([*map(F.col, fields), F.col("text")]).alias("leaf"), tampered.alias("tampered")), "lang", ["doc_id"]))
    folded = found.withColumn("folded_root", fold(F.coalesce("row.tampered", "leaf"), F.col("places"), F.col("siblings")))
    return folded.select(
        F.col("row.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _part(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({value} AS VARCHAR))), ':', {value}) END"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(map(_part, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


# Levels of eight: enough for 8**LEVELS rows of a language.
_LEVELS, _TOP_LEVELS = 8, 2
# CRC-32 by its definition: eight shifts a byte, reversed polynomial 0xEDB88320.
_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))), lambda c, d: xor(c // 256, crc_table[CAST(xor(c % 256, d) + 1 AS INT)])), 4294967295)"


def _merkle_levels(prefix: str, levels: int, group: str) -> str:
    """Nodes level by level, runs of eight; where one node is left it stays as it is."""
    by = f"{group}, " if group else ""
    out = []
    for k in range(levels):
        out.append(f"""{prefix}run{k} AS (
            SELECT {by}index // 8 AS parent, list(digest ORDER BY index) AS run, max(n) AS n FROM {prefix}{k} GROUP BY {by}parent
        ), {prefix}{k + 1} AS (
            SELECT {by}parent AS index, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS digest, CASE WHEN n = 1 THEN 1 ELSE (n + 7) // 8 END AS n FROM {prefix}run{k}
        )""")
    return ", ".join(out)


def _merkle_steps(prefix: str, levels: int, start: str, place: str, group: str) -> tuple[str, str]:
    """CTEs that carry each document from level to level: its siblings so far and its folded digest."""
    out, last = [], start
    for k in range(levels):
        at = f"({place} // {8**k}) % 8"
        on = f"s.{place} // {8 ** (k + 1)} = r.parent" + (f" AND s.{group} IS NOT DISTINCT FROM r.{group}" if group else "")
        out.append(f"""{prefix}step{k} AS (
            SELECT s.* REPLACE (
                CASE WHEN r.n = 1 THEN proof ELSE proof || array_to_string(list_concat(run[1:{at}], run[{at} + 2:]), '') END AS proof,
                CASE WHEN r.n = 1 THEN folded ELSE sha256(array_to_string(list_concat(run[1:{at}], [folded], run[{at} + 2:]), '')) END AS folded
            ) FROM {last} s JOIN {prefix}run{k} r ON {on}
        )""")
        last = f"{prefix}step{k}"
    return ", ".join(out), last


_STEPS, _LAST = _merkle_steps("node", _LEVELS, "begun", "index", "lang")
_TOP_STEPS, _TOP_LAST = _merkle_steps("top", _TOP_LEVELS, "risen", "tree", "")
ORACLES["op12_merkle_manifest"] = f"""
    WITH tables AS (SELECT {_CRC_TABLE} AS crc_table),
    leaves AS (
        SELECT doc_id, lang, {_leaf_sql("text")} AS leaf,
               CASE WHEN {_CRC} % 3 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
        FROM documents, tables
    ),
    begun AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS index, '' AS proof, coalesce(tampered, leaf) AS folded FROM leaves
    ),
    node0 AS (SELECT lang, index, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM begun),
    {_merkle_levels("node", _LEVELS, "lang")},
    trees AS (SELECT lang, digest, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM node{_LEVELS}),
    top0 AS (SELECT tree AS index, digest, count(*) OVER () AS n FROM trees),
    {_merkle_levels("top", _TOP_LEVELS, "")},
    {_STEPS},
    risen AS (SELECT s.*, tree, digest AS subroot FROM {_LAST} s JOIN trees t ON s.lang IS NOT DISTINCT FROM t.lang),
    {_TOP_STEPS}
    SELECT doc_id, leaf, subroot, root.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.digest AS verified
    FROM {_TOP_LAST}, top{_TOP_LEVELS} AS root
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, among all."""
    from payfeed.llm.hardneg import candidates, mine

    rows = candidates(table(spark, sf_dir, "embeddings"))
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", noisy), F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
    WITH rows AS (
        SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR 256 * abs(x) >= 4194304)) = 0
    ),
    scored AS (
        SELECT a.n AS anchor, a.vec_id AS anchor_id, r.n, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
        FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0
    ),
    positives AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS p FROM scored WHERE same),
    negatives AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.anchor, p.p ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
        FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
        WHERE p.p <= 5
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
