"""URL filter: pattern rules indexed by their rarest literal token.

Every rule names literal tokens that any URL it matches must hold. The corpus is counted once, and
each rule is filed under the one of its tokens that the fewest URLs hold. A URL's distinct tokens
then fetch their rules, and only those run as regular expressions. DataFrame functions only.

Defined cases: a null URL and one without ``://`` have an empty host and path, fit no rule and are
allowed. Repeated rows come back as often. Of rules that fit, host rules go before patterns, longer
before shorter, and of equally long ones the first by its text wins. Extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.operators.joins import lookup

#: What separates the tokens of a URL in lower case.
NOT_TOKEN = "[^a-z0-9]+"

ALLOW, BLOCK = "allow", "block"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for URLs whose address, ``host?path`` with the host in lower case, fits ``pattern``.

    Neither a host nor a path holds a question mark.

    ``tokens`` are literal tokens that every such URL holds whole. ``name`` is the text of a rule
    that is reported, or None for a rule of the method's own.
    """

    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    name: str | None = None


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and all its subdomains, for paths that begin with ``path``."""
    pattern = rf"^([^?]*\.)?{re.escape(host)}\?{re.escape(path)}"
    # The path's last token may go on in a URL unless a slash ends it.
    closed = path if path.endswith("/") else path.rpartition("/")[0]
    tokens = tuple(t for t in re.split(NOT_TOKEN, f"{host} {closed}") if t)
    return Rule(verdict, pattern, tokens, f"{host}{path}")


#: The rules that the contract fixes.
BASE = (
    host_rule(BLOCK, "net", "/"),
    host_rule(ALLOW, "example.net", "/en/"),
    host_rule(BLOCK, "example.com", "/de/"),
    host_rule(ALLOW, "org", "/fr/"),
)

#: The method's own, by shape: two words side by side anywhere, the first label of a host, a folder of
#: the path, the file that a path ends with, and its ending.
PATTERNS = (
    *(
        Rule(BLOCK, rf"(?i)(^|[^a-z0-9]){first}[^a-z0-9]{second}([^a-z0-9]|$)", (first, second))
        for first, second in (
            ("spam", "farm"),
            ("cheap", "pills"),
            ("link", "farm"),
            ("free", "casino"),
            ("casino", "bonus"),
            ("online", "casino"),
            ("payday", "loans"),
            ("adult", "video"),
            ("xxx", "videos"),
            ("wp", "login"),
            ("replica", "watches"),
            ("malware", "download"),
        )
    ),
    *(Rule(BLOCK, rf"^{label}[0-9-]*\.[^?]", (label,)) for label in ("ads", "adserver", "banners", "clicktracker", "popunder")),
    *(
        Rule(BLOCK, rf"(?i)\?(.*/)?{folder}/", tuple(folder.split("-")))
        for folder in ("wp-admin", "cgi-bin", "phishing", "warez")
    ),
    *(Rule(BLOCK, rf"(?i)\?(.*/)?{name}\.{end}$", (*name.split("-"), end)) for name, end in (("xmlrpc", "php"), ("wp-cron", "php"))),
    *(Rule(BLOCK, rf"(?i)\.{end}$", (end,)) for end in ("exe", "scr", "apk", "torrent")),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/ ? #``, then up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.translate(F.coalesce(host, empty), UPPER, LOWER), F.coalesce(path, empty)


def rule_index(spark: SparkSession, rules: tuple[Rule, ...], tokens: DataFrame) -> DataFrame:
    """``token, verdict, pattern, name``: every rule under the rarest of its tokens in ``tokens (token, n)``."""
    if any(not r.tokens for r in rules):
        raise ValueError("every rule needs a literal token")
    rows = [(i, t, r.verdict, r.pattern, r.name) for i, r in enumerate(rules) for t in r.tokens]
    names = ("rule_id", "token", "verdict", "pattern", "name")
    literal = [F.struct(*[F.lit(v).cast("int" if c == "rule_id" else "string").alias(c) for c, v in zip(names, row, strict=True)]) for row in rows]
    table = spark.range(1).select(F.inline(F.array(*literal)))
    wanted = tokens.join(F.broadcast(table.select("token").distinct()), "token").groupBy("token").agg(F.sum("n").alias("n"))
    counted = table.join(wanted, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.groupBy("rule_id", "verdict", "pattern", "name").agg(
        F.min_by("token", F.struct("n", "token")).alias("token")
    )


def judge(pages: DataFrame, rules: tuple[Rule, ...] = BASE + PATTERNS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages (page_id, url)``.

    Distinct host and path pairs are judged and joined back. The rules are a parameter of the
    program, a few short rows each, and so is their index, which is broadcast.
    """
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).select(
        "page_id", "host", "path", F.concat_ws("?", "host", "path").alias("address")
    )
    distinct = rows.groupBy("address").agg(F.count(F.lit(1)).alias("n"))
    address = F.col("address")
    tokens = distinct.select(
        "address", "n", F.explode_outer(F.array_distinct(F.split(F.lower(address), NOT_TOKEN))).alias("token")
    )
    index = rule_index(pages.sparkSession, rules, tokens)
    # Host rules first, then the longest.
    rank = F.struct(
        F.col("name").isNotNull(), F.length(F.coalesce("name", "pattern")), F.col("pattern")
    )
    best = (
        tokens.join(F.broadcast(index), "token")
        .where(F.regexp_like(address, F.col("pattern")))
        .groupBy("address")
        .agg(F.max_by(F.struct("name", "verdict"), rank).alias("best"))
    )
    # Only addresses that a rule fits are looked up; an address of many rows is spread over tasks.
    return lookup(rows, materialize(best, "judged"), "address", "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"),
    )
