"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host + path`` with literal tokens (runs of a-z0-9)
that any fitting URL must hold. Spark counts, over all URLs, in how many each of these
tokens occurs; a rule is filed under its rarest one. A URL's own tokens fetch the candidate
rules, and only those regular expressions run (rules without a literal always run).

Site rules (host, path) fit their host and all its subdomains when the path starts with the
rule's; the longest wins (on a tie a block). Where none fits, pattern rules decide, a block before
an allow, and ``default`` (allow) if none of them fits either.

The index is sent to the executors as a broadcast of at most ``RULES_PER_PASS`` rules; larger
sets are judged in several passes over the columns, whose best results are combined.

Defined results: a null url, or one without ``://``, has empty host and path, a null rule and
the default verdict; repeated rows are judged alike; other columns stay untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewscope.llm.common import read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES_PER_PASS = 100_000
_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; ``size`` orders site rules (0: a pattern rule)."""
    name: str
    action: str
    pattern: str
    literals: tuple[str, ...]
    size: int = 0


def site_rule(site: str, action: str) -> Rule:
    """A rule written as host/path, e.g. ``example.com/en/``."""
    host, slash, path = site.partition("/")
    host = host.lower()
    whole = (slash + path)[: (slash + path).rfind("/") + 1] if not re.search(r"[^A-Za-z0-9]$", path) else slash + path
    tokens = _TOKEN.findall(host) + _TOKEN.findall(whole.lower())
    return Rule(site, action, rf"\A(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}", tuple(tokens), len(site))


def pattern_rule(name: str, action: str, pattern: str, *literals: str) -> Rule:
    return Rule(name, action, pattern, literals)


#: Junk hosts by the words in their names.
DEFAULT_PATTERNS = tuple(
    pattern_rule(f"host:{w}", "block", rf"\A[^/]*(?<![a-z0-9]){w}(?![a-z0-9])[^/]*(?:/|\Z)", w)
    for w in ("casino", "bets", "betting", "poker", "spam", "adult", "porn", "xxx", "viagra", "pills", "payday", "warez"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """In how many rows of ``urls`` each literal of the rules occurs (one count per literal)."""
    literals = sorted({t for r in rules for t in r.literals})
    if not literals:
        return {}
    known = urls.sparkSession.createDataFrame([(t,) for t in literals], "token string")
    tokens = F.regexp_extract_all(F.translate("url", UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0))
    counts = (urls.select(F.explode(F.array_distinct(tokens)).alias("token"))
              .join(F.broadcast(known), "token").groupBy("token").count().collect())
    return {r["token"]: r["count"] for r in counts}


def rule_index(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[tuple]]:
    """(size, block, name, pattern) by rarest literal; rules without any under the empty string."""
    index: dict[str, list[tuple]] = {}
    for r in rules:
        key = min(r.literals, key=lambda t: (counts.get(t, 0), t)) if r.literals else ""
        index.setdefault(key, []).append((r.size, r.action == "block", r.name, r.pattern))
    return index


def _judge_pass(spark, rules: list[Rule], counts: dict[str, int]) -> Column:
    index = spark.sparkContext.broadcast(rule_index(rules, counts))

    @F.pandas_udf("size int, block boolean, name string")
    def judge(url: pd.Series, host: pd.Series, path: pd.Series) -> pd.DataFrame:
        table, out = index.value, []
        for u, h, p in zip(url, host, path):
            best, subject = None, h + p
            tokens = set(_TOKEN.findall((u or "").lower())) if h or p else ()
            for *rank, pattern in (r for t in ("", *tokens) for r in table.get(t, ())):
                if (best is None or rank > best) and re.search(pattern, subject):
                    best = rank
            out.append(best or (None, None, None))
        return pd.DataFrame(out, columns=["size", "block", "name"])

    return judge(F.col("url"), F.col("_llm_host"), F.col("_llm_path"))


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow",
               per_pass: int = RULES_PER_PASS) -> DataFrame:
    """All columns of ``pages`` plus _llm_host, _llm_path, _llm_rule and _llm_verdict."""
    host, path = host_and_path(F.col("url"))
    out = pages.withColumns({"_llm_host": host, "_llm_path": path})
    best = F.lit(None).cast("struct<size:int,block:boolean,name:string>")
    for k in range(0, len(rules), per_pass):
        part = rules[k:k + per_pass]
        one = _judge_pass(pages.sparkSession, part, token_counts(pages.select("url"), part))
        out = out.withColumn(f"_llm_best{k}", one)
        best = F.greatest(best, F.col(f"_llm_best{k}")) if k else F.col("_llm_best0")
    out = out.withColumn("_llm_best", best)
    verdict = F.when(F.col("_llm_best.block"), "block").when(~F.col("_llm_best.block"), "allow").otherwise(default)
    rule = F.when(F.col("_llm_best.size") > 0, F.col("_llm_best.name"))
    return out.withColumns({"_llm_rule": rule, "_llm_verdict": verdict}).drop(
        "_llm_best", *[f"_llm_best{k}" for k in range(0, len(rules), per_pass)])


#: The rules of the registered query.
SITES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))


def op9_url_rules(spark, sf_dir: str) -> DataFrame:
    rules = [site_rule(*x) for x in SITES] + list(DEFAULT_PATTERNS)
    out = judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("page_id", F.col("_llm_host").alias("host"), F.col("_llm_path").alias("path"),
                      F.col("_llm_rule").alias("rule"), F.col("_llm_verdict").alias("verdict"))


_WORDS = "casino|bets|betting|poker|spam|adult|porn|xxx|viagra|pills|payday|warez"
SQL = rf"""
WITH a AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '\A[^/?#]*') AS raw FROM a),
c AS (
  SELECT row_number() OVER () AS n, page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '\A[^?#]*') AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest, coalesce(raw, '') AS raw FROM b)),
r(rule, rhost, rpath, action) AS (VALUES {", ".join(f"('{s}', '{s.partition('/')[0]}', '/{s.partition('/')[2]}', '{a}')" for s, a in SITES)}),
f AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM c JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n)
SELECT page_id, host, path, rule,
       CASE WHEN action IS NOT NULL THEN action
            WHEN regexp_matches(host, '(\A|[^a-z0-9])({_WORDS})([^a-z0-9]|\z)') THEN 'block'
            ELSE 'allow' END AS verdict
FROM c LEFT JOIN f USING (n)
"""
