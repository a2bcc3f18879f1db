"""URL filters: pattern rules indexed by their rarest literal token.

A rule's literal tokens are those that any URL it fits must hold as whole tokens. The rule is filed under the one that
occurs in the fewest URLs of the table. A URL's own tokens fetch the rules filed under them, and only those run their
regular expression; a rule without a literal token runs on every URL.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.columns import add_from_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[^a-z0-9]+"
_FOLD = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Rule:
    """A verdict for the URLs whose host and path a regular expression finds.

    `tokens` are lower-case runs of letters and digits that stand in every such URL between other characters. Of the
    rules that fit, the one of the highest (rank, name) decides.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    allow: bool
    rank: int


def host_path_rule(name: str, allow: bool, rank: int = 1 << 20) -> Rule:
    """A rule `host/path`: the host and all its subdomains, with paths that begin with the rule's. Longer rules win.

    The last run of the path may go on in a URL, so it is no literal token unless something closes it.
    """
    host, slash, path = name.partition("/")
    closed = re.split(TOKEN, (slash + path).lower())[:-1]
    tokens = {t for t in [*re.split(TOKEN, host.lower()), *closed] if t}
    pattern = rf"\A(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    return Rule(name, pattern, tuple(sorted(tokens)), allow, rank + len(name))


def word_rule(name: str, words: Sequence[str]) -> Rule:
    """Block hosts that hold the words in a row, divided by one dash, dot or underscore."""
    body = "[-._]".join(map(re.escape, words))
    return Rule(name, rf"\A[^/]*(?<![a-z0-9]){body}(?![a-z0-9])", tuple(sorted(set(words))), False, 0)


# The rules of the contract, and hosts that sell or farm links.
HOST_PATH_RULES = [
    host_path_rule("org/", True),
    host_path_rule("example.org/es/", False),
    host_path_rule("example.org/en/1", False),
    host_path_rule("com/fr/", True),
    host_path_rule("com/de/", False),
]
SPAM_WORDS = {
    "spam farm": ["spam", "farm"],
    "cheap pills": ["cheap", "pills"],
    "link farm": ["link", "farm"],
    "free casino": ["free", "casino"],
    "adult content": ["adult"],
}
METHOD_RULES = [word_rule(name, words) for name, words in SPAM_WORDS.items()]


def add_host_and_path(pages: DataFrame, url_col: str) -> DataFrame:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A to Z lower-cased. Path: then up to `?`, `#` or end."""
    marked = pages.withColumn("__url", F.coalesce(F.col(url_col).cast("string"), F.lit("")))
    rest = "CASE WHEN locate('://', __url) > 0 THEN substring(__url, locate('://', __url) + 3) ELSE '' END"
    marked = marked.withColumn("__rest", F.expr(rest))
    return (
        marked.withColumn("host", F.translate(F.regexp_extract("__rest", r"^[^/?#]*", 0), UPPER, LOWER))
        .withColumn("path", F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1))
        .drop("__url", "__rest")
    )


def tokens_of(text: str) -> set[str]:
    return set(re.split(TOKEN, text.translate(_FOLD)))


class RuleIndex:
    """Rules filed under their rarest literal token; `counts` says in how many URLs a token occurs."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]):
        self.filed: dict[str, list] = defaultdict(list)
        self.always: list = []
        for rule in rules:
            entry = (rule.rank, rule.name, rule.allow, re.compile(rule.pattern))
            if rule.tokens:
                self.filed[min(rule.tokens, key=lambda t: (counts.get(t, 0), t))].append(entry)
            else:
                self.always.append(entry)

    def decide(self, host: str, path: str) -> tuple | None:
        """The (rank, name, allow) that decides, or None."""
        subject = host + path
        best = None
        for entry in [*self.always, *(e for t in tokens_of(subject) for e in self.filed.get(t, ()))]:
            if (best is None or entry[:2] > best[:2]) and entry[3].search(subject):
                best = entry[:3]
        return best


def count_tokens(pages: DataFrame, wanted: Sequence[str]) -> dict[str, int]:
    """In how many rows each wanted token occurs: one row per token reaches the driver."""
    if not wanted:
        return {}
    found = F.split(F.translate(F.concat("host", "path"), UPPER, LOWER), TOKEN)
    hits = pages.select(F.explode(F.array_intersect(found, F.array(*map(F.lit, wanted)))).alias("token"))
    return {r.token: r.n for r in hits.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], fallback: Sequence[Rule], url_col: str = "url"
) -> DataFrame:
    """Add host, path, rule and verdict (allow or block) to every row.

    Of the `rules` that fit, the one of the highest rank decides and is named; otherwise rule is null and the verdict is
    block if any of `fallback` fits, else allow. A null URL or one without `://` has an empty host and path. Rows that
    repeat are judged alike; an empty table gives no rows; other columns stay, but for those with the name of an added
    one. The rules are given by the caller and go to the tasks with the function.
    """
    split = add_host_and_path(pages, url_col)
    wanted = sorted({t for r in [*rules, *fallback] for t in r.tokens})
    counts = count_tokens(split.select("host", "path"), wanted)
    own, rest = RuleIndex(rules, counts), RuleIndex(fallback, counts)
    text = T.StringType()

    def judge(hosts: pa.Array, paths: pa.Array) -> list[pa.Array]:
        names, verdicts = [], []
        for host, path in zip(hosts.to_pylist(), paths.to_pylist()):
            found = own.decide(host, path)
            names.append(found[1] if found else None)
            allowed = found[2] if found else rest.decide(host, path) is None
            verdicts.append("allow" if allowed else "block")
        return [hosts, paths, pa.array(names, pa.string()), pa.array(verdicts, pa.string())]

    added = T.StructType([T.StructField(c, text) for c in ("host", "path", "rule", "verdict")])
    return add_from_batches(split, ["host", "path"], added, judge)
