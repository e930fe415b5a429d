"""URL filter: host and path rules, then pattern rules fetched by their rarest literal token.

Pattern rules are written in the usual filter syntax: ``*`` stands for any text, ``^`` for a separator or the end, ``||``
at the front for the start of a host label, ``|`` for the start or end of the url; ``@@`` in front makes an exception.
A url is cut into tokens once; the index gives the rules filed under any of them, and only those run their expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HostRule:
    """Holds for ``host`` and its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


HOST_RULES = (
    HostRule("org", "/", "allow"),
    HostRule("example.org", "/es/", "block"),
    HostRule("example.org", "/en/1", "block"),
    HostRule("com", "/fr/", "allow"),
    HostRule("com", "/de/", "block"),
)

PATTERN_RULES = (
    "||casino",
    "-casino.",
    "casino-win.",
    "||ads.",
    "/ads/",
    "/banner/*.gif",
    "^adclick^",
    "^affiliate^*^id=",
    "/wp-login.php",
    "/cgi-bin/",
    "^porn^",
    "^xxx^",
    "free-pills.",
    "cheap-loans.",
    "/login^*^return=",
    "^session_id=",
    "*.exe|",
    "@@||example.net/ads/policy",
)

TOKEN = re.compile("[a-z0-9]+")
_SEPARATOR = "(?:[^a-z0-9_.%-]|$)"


def to_regex(pattern: str) -> str:
    """The pattern as a regular expression over the url in lower case, in syntax common to Python and RE2."""
    body = pattern.removeprefix("@@").lower()
    head = tail = ""
    if body.startswith("||"):
        body, head = body[2:], r"^[a-z0-9+.-]+://(?:[^/?#]*\.)?"
    elif body.startswith("|"):
        body, head = body[1:], "^"
    if body.endswith("|"):
        body, tail = body[:-1], "$"
    return head + "".join(".*" if c == "*" else _SEPARATOR if c == "^" else re.escape(c) for c in body) + tail


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every matching url has whole: runs of letters and digits between literal or separator characters."""
    body = pattern.removeprefix("@@").lower()
    marked = ("." if body.startswith("|") else "*") + body.lstrip("|")
    marked = marked[:-1] + "." if marked.endswith("|") else marked + "*"
    return [m[0] for m in TOKEN.finditer(marked) if marked[m.start() - 1] != "*" and marked[m.end()] != "*"]


class RuleIndex:
    """Rules filed under their rarest literal token; ``counts`` gives how often urls have a token."""

    def __init__(self, patterns: Iterable[str], counts: dict[str, int]):
        self.by_token: dict[str, list[int]] = {}
        self.rest: list[int] = []
        self.rules: list[tuple[bool, str]] = []
        self._compiled: dict[int, re.Pattern] = {}
        for n, pattern in enumerate(patterns):
            self.rules.append((pattern.startswith("@@"), to_regex(pattern)))
            tokens = literal_tokens(pattern)
            if tokens:
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
                self.by_token.setdefault(rarest, []).append(n)
            else:
                self.rest.append(n)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_compiled": {}}

    def candidates(self, url: str) -> list[int]:
        found = set(self.rest)
        for token in TOKEN.findall(url):
            found.update(self.by_token.get(token, ()))
        return sorted(found)

    def verdict(self, url: str | None) -> str:
        """Block if a rule matches and no exception does, else allow; null counts as the empty url."""
        url = lower_ascii(url or "")
        hits = set()
        for n in self.candidates(url):
            if n not in self._compiled:
                self._compiled[n] = re.compile(self.rules[n][1], re.DOTALL | re.ASCII)
            if self._compiled[n].search(url):
                hits.add(self.rules[n][0])
        return "block" if hits == {False} else "allow"


_LOWER = {c: c + 32 for c in range(65, 91)}


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def _lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: from there up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return (
        _lower(F.coalesce(F.regexp_extract(rest, "^([^/?#]*)", 1), F.lit(""))),
        F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")),
    )


def host_rule(host: Column, path: Column, rules: Iterable[HostRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null where none does; of equally long ones the first listed."""
    name = verdict = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.name))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def token_counts(pages: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many times the urls have each of the rules' tokens: as many rows as the rules have tokens."""
    if not tokens:
        return {}
    found = pages.select(F.explode(F.regexp_extract_all(_lower(F.col("url")), F.lit("([a-z0-9]+)"), F.lit(1))).alias("token"))
    return {r["token"]: r["n"] for r in found.where(F.col("token").isin(sorted(tokens))).groupBy("token").agg(F.count("*").alias("n")).collect()}


def judge_urls(pages: DataFrame, host_rules: Iterable[HostRule] = HOST_RULES, patterns: Iterable[str] = PATTERN_RULES) -> DataFrame:
    """All rows of ``pages`` with host, path, rule and verdict; columns of these names in the input are replaced.

    The verdict is the host rule's; where none fits, that of the pattern rules. A null url, or one without ``://``, has an
    empty host and path. The rules are a parameter and travel with the plan; urls are judged where they are read.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    patterns = list(patterns)
    index = RuleIndex(patterns, token_counts(pages, {t for p in patterns for t in literal_tokens(p)}))

    @F.pandas_udf("string")
    def by_pattern(urls: pd.Series) -> pd.Series:
        return urls.map(index.verdict, na_action=None)

    host, path = host_and_path(F.col("url"))
    rows = pages.withColumn("host", host).withColumn("path", path)
    name, verdict = host_rule(F.col("host"), F.col("path"), host_rules)
    return rows.withColumn("rule", name).withColumn("verdict", F.coalesce(verdict, by_pattern("url")))


def verdict_sql(patterns: Iterable[str] = PATTERN_RULES) -> str:
    """The pattern rules as one SQL condition on ``url_low``, for comparison."""
    patterns = list(patterns)
    quote = lambda p: "regexp_matches(url_low, '(?s)" + to_regex(p).replace("'", "''") + "')"
    block = " OR ".join(quote(p) for p in patterns if not p.startswith("@@")) or "false"
    spare = " OR ".join(quote(p) for p in patterns if p.startswith("@@")) or "false"
    return f"CASE WHEN ({block}) AND NOT ({spare}) THEN 'block' ELSE 'allow' END"
