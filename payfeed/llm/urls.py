"""URL filter: rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` with literal tokens that every
match contains. How often tokens occur is counted over all URLs, and each rule stands in the index
under its rarest one. The tokens of a URL fetch candidates, and only their expressions
run. Rules are broadcast in blocks of at most ``RULES``; each block visits all URLs.

Host rules come first: the longest that fits decides. Where none fits, the patterns of the
method decide (any that fits blocks), and else the URL is allowed.

Nulls: a null URL or one without ``://`` has empty host and path, which fits no rule and is
allowed. Rules of equal length are taken in their order. Rows are returned once each.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
RULES = 50_000
_TOKEN = re.compile("[a-z0-9]+", re.IGNORECASE)


@dataclass(frozen=True)
class Rule:
    """What a fitting URL gets; ``size`` ranks host rules, patterns have size 0."""

    name: str
    verdict: str
    expression: str
    tokens: tuple[str, ...]
    size: int = 0


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    # A token that ends the prefix may go on in a URL, so it is not literal.
    ended = re.sub("[A-Za-z0-9]+$", "", path)
    tokens = tuple(_TOKEN.findall(host)) + tuple(_TOKEN.findall(ended))
    return Rule(host + path, verdict, rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tokens, len(host) + len(path))


def word_pattern(word: str) -> Rule:
    """Blocks hosts that have ``word`` between marks."""
    return Rule(f"*{word}*", BLOCK, rf"(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?![a-z0-9])", (word,))


# The rules of the query.
HOST_RULES = [
    host_rule(ALLOW, "com", "/"),
    host_rule(BLOCK, "example.com", "/en/"),
    host_rule(ALLOW, "www.example.com", "/en/"),
    host_rule(BLOCK, "net", "/es/"),
    host_rule(BLOCK, "net", "/fr/"),
]
# Words in hosts of gambling, pills and adult sites.
BLOCKED_WORDS = ["adult", "bet", "bets", "betting", "casino", "gambling", "jackpot", "pills", "poker", "porn", "replica", "sex", "slots", "viagra", "warez", "xxx"]
PATTERNS = [word_pattern(w) for w in BLOCKED_WORDS]


def host_column(url: F.Column) -> F.Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_column(url: F.Column) -> F.Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: F.Column) -> F.Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _tokens(host: str, path: str) -> set[str]:
    return {*_TOKEN.findall(host), *_TOKEN.findall(path)}


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many URLs (``host``, ``path``) each of ``tokens`` occurs."""
    spark = urls.sparkSession
    asked = spark.createDataFrame([(t,) for t in tokens], "token string")
    parts = F.concat(F.split("host", "[^A-Za-z0-9]+"), F.split("path", "[^A-Za-z0-9]+"))
    found = urls.select(F.explode(F.array_distinct(parts)).alias("token")).groupBy("token").count().join(asked, "token")
    return {r["token"]: r["count"] for r in found.collect()}  # at most one row a token of the rules


def judge(pages: DataFrame, columns: list[str], host_rules: list[Rule] = HOST_RULES, patterns: list[Rule] = PATTERNS) -> DataFrame:
    """``columns`` of ``pages`` with host, path, rule, pattern and verdict of ``url``."""
    url = F.col("url").cast("string")
    found = pages.select(*columns, host_column(url).alias("host"), path_column(url).alias("path"))
    found = found.withColumns({"rule": F.lit(None).cast("string"), "_verdict": F.lit(None).cast("string"), "_size": F.lit(-1), "pattern": F.lit(None).cast("string")})
    rules = [*host_rules, *patterns]
    counts = token_counts(found, sorted({t for r in rules for t in r.tokens})) if rules else {}
    for at in range(0, len(rules), RULES):
        found = _apply(found, rules[at : at + RULES], counts)
    verdict = F.coalesce("_verdict", F.when(F.col("pattern").isNotNull(), BLOCK).otherwise(ALLOW))
    return found.select(*columns, "host", "path", "rule", "pattern", verdict.alias("verdict"))


def _apply(found: DataFrame, rules: list[Rule], counts: dict[str, int]) -> DataFrame:
    table = found.sparkSession.sparkContext.broadcast((rules, counts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules, counts = table.value
        index: dict[str, list[tuple[int, re.Pattern, Rule]]] = {}
        for number, rule in enumerate(rules):
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            index.setdefault(rarest, []).append((number, re.compile(rule.expression), rule))
        for batch in batches:
            rule_of, verdict, size, pattern = (batch[c].tolist() for c in ("rule", "_verdict", "_size", "pattern"))
            for i, (host, path) in enumerate(zip(batch["host"], batch["path"])):
                fetched = [c for token in _tokens(host, path) & index.keys() for c in index[token]]
                for _, expression, rule in sorted(fetched, key=lambda c: c[0]):
                    if not expression.match(host + path):
                        continue
                    if rule.size > size[i] and rule.size:
                        rule_of[i], verdict[i], size[i] = rule.name, rule.verdict, rule.size
                    elif not rule.size and pattern[i] is None:
                        pattern[i] = rule.name
            yield batch.assign(rule=rule_of, _verdict=verdict, _size=size, pattern=pattern)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return found.mapInPandas(run, schema)
