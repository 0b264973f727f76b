"""URL verdicts from pattern rules that are indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` with literal tokens (runs of
``[a-z0-9]``) that every match contains. The document frequency of the rules' tokens
over all URLs picks each rule's rarest token; a URL's own tokens fetch the rules
indexed under them, and only those rules' expressions run against the URL.
Everything is DataFrame functions; the two tables that are broadcast are the rule
index and the rule-token list, both no larger than the given rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import under, written

TOKEN = "[^a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``site`` rules carry a name and outrank pattern rules; the longest name wins.
    Every match of ``pattern`` (over lower-cased host + path) contains all ``tokens``."""

    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    name: str | None = None


def site_rule(rule: str, verdict: str) -> Rule:
    """A rule ``host/path``: the host and its subdomains, path starting with ``/path``.

    Its tokens are those of the host and of the path's whole segments: the last segment
    may continue in the URL. The host holds no slash, so the expression can run on
    host + path."""
    host, _, path = rule.partition("/")
    whole = f"{host}/{path.rpartition('/')[0]}".lower()
    tokens = tuple(t for t in re.split(TOKEN, whole) if t)
    return Rule(rf"^(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}", verdict, tokens, rule)


def word_rule(words: str, verdict: str) -> Rule:
    """A rule for literal words, such as ``cheap-pills``, standing alone anywhere in host
    or path, in either case."""
    tokens = tuple(t for t in re.split(TOKEN, words.lower()) if t)
    return Rule(rf"(?i)(?:^|[^a-z0-9]){re.escape(words)}(?:[^a-z0-9]|$)", verdict, tokens)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for a null url or one without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where the host rule finds no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(target: Column) -> Column:
    """Distinct literal tokens of a host + path."""
    lowered = F.translate(target, UPPER, LOWER)
    return F.array_remove(F.array_distinct(F.split(lowered, TOKEN)), "")


def rarest_token_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, rule_id, ...): each rule under the token that the fewest URLs contain.

    ``urls`` has ``tokens``; only tokens that some rule names are counted, with a
    partial sum in each task, so the counted table is as small as the rule list.
    """
    wanted = rules.select("rule_id", F.explode("tokens").alias("token"))
    counted = (urls.select(F.explode("tokens").alias("token"))
               .join(F.broadcast(wanted.select("token").distinct()), "token")
               .groupBy("token").agg(F.count("*").alias("df")))
    rarest = (wanted.join(counted, "token", "left").fillna(0, "df")
              .groupBy("rule_id").agg(F.min(F.struct("df", "token")).alias("best")))
    return rules.join(rarest, "rule_id").select(
        F.col("best.token").alias("token"), "rule_id", "pattern", "verdict", "name")


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow",
          url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (name of the longest fitting site rule, else null),
    pattern_id (number of the first fitting word rule if no site rule fits, else null)
    and verdict (that rule's, else ``default``); the given columns are under ``page``.

    Null and malformed URLs have empty host and path, fit no rule and get ``default``.
    Repeated rows are judged each. An empty table gives an empty result. Given columns
    of any name stay inside ``page`` and cannot clash.
    """
    if not all(r.tokens for r in rules):
        raise ValueError("every rule needs a literal token to be indexed by")
    table = pages.sparkSession.createDataFrame(
        [(i, r.pattern, r.verdict, list(r.tokens), r.name) for i, r in enumerate(rules)],
        "rule_id int, pattern string, verdict string, tokens array<string>, name string")
    url = F.col(f"`{url_col}`")
    urls = written(
        pages.select(under("page", pages), host_of(url).alias("host"), path_of(url).alias("path"),
                     F.monotonically_increasing_id().alias("rid"))
        .withColumn("tokens", tokens_of(F.concat("host", "path"))), "urls")
    index = written(rarest_token_index(urls, table), "rule_index")
    # A rule is indexed under one token and a URL's tokens are distinct, so a rule is
    # fetched by a URL once at most.
    fits = (urls.select("rid", F.concat("host", "path").alias("target"),
                        F.explode("tokens").alias("token"))
            .join(F.broadcast(index), "token")
            .where(F.expr("target rlike pattern")))
    rank = F.struct(F.col("name").isNull().alias("unnamed"), (-F.length("name")).alias("len"),
                    "rule_id", "name", F.col("verdict").alias("said"))
    best = fits.groupBy("rid").agg(F.min(rank).alias("best"))
    return urls.join(best, "rid", "left").select(
        "page", "host", "path", F.col("best.name").alias("rule"),
        F.when(F.col("best.unnamed"), F.col("best.rule_id")).alias("pattern_id"),
        F.coalesce("best.said", F.lit(default)).alias("verdict"))
