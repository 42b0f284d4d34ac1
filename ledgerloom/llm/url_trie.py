"""URL rules in a trie over reversed host labels and path segments.

A rule is a host and the beginning of a path, to be allowed or blocked. It fits the host and its subdomains, where the
url's path starts with the rule's; of all rules that fit, the longest (host and path together) decides, and of equally
long ones the block. Host labels are walked from the last to the first, then whole path segments; what a rule holds
after its last slash is kept at the node as a beginning of the next segment. The trie is sent to all executors once;
its size is bounded by MOST_RULES and MOST_BYTES, and longer lists raise an error.

NULL urls and urls without :// have an empty host and path, which no rule fits.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RULES = 1_000_000
#: Bytes of their hosts and paths, which bound the number of nodes, too.
MOST_BYTES = 32 << 20
#: Keys of a trie node: rules that end here by their rest after the last slash, children by label, by segment.
RULES, LABELS, SEGMENTS = 0, 1, 2


def node() -> tuple[dict, dict, dict]:
    return {}, {}, {}


def build(rules: Iterable[tuple[str, str, str]]) -> tuple:
    """Trie of (verdict, host, path) rules; hosts in lower case, paths empty or from their slash."""
    root, count, size = node(), 0, 0
    for verdict, host, path in rules:
        count += 1
        size += len(f"{host}{path}".encode())
        if count > MOST_RULES or size > MOST_BYTES:
            raise ValueError(f"over {MOST_RULES} rules or {MOST_BYTES} bytes of them are too many to send to every executor")
        if verdict not in ("allow", "block") or not host or path[:1] not in ("", "/"):
            raise ValueError(f"not a rule: {verdict} {host}{path}")
        at = root
        for label in reversed(host.split(".")):
            at = at[LABELS].setdefault(label, node())
        *whole, rest = path.split("/") if path else [""]
        for segment in whole:
            at = at[SEGMENTS].setdefault(segment, node())
        if at[RULES].get(rest, (None, None))[0] != "block":
            at[RULES][rest] = (verdict, host + path)
    return root


def judge(root: tuple, host: str, path: str) -> tuple[str | None, str | None]:
    """(rule, verdict) of the longest rule that fits; (None, None) if none does."""
    best: tuple[int, bool, str | None, str | None] = (-1, False, None, None)
    segments = path.split("/")
    at = root
    for label in reversed(host.split(".")):
        at = at[LABELS].get(label)
        if at is None:
            break
        below, depth = at, 0
        while below is not None:
            left = "/".join(segments[depth:]) if any(below[RULES]) else ""
            for rest, (verdict, name) in below[RULES].items():
                if (not rest or left.startswith(rest)) and (found := (len(name), verdict == "block", name, verdict))[:2] > best[:2]:
                    best = found
            # the last segment has no slash behind it, so it is no whole one
            below = below[SEGMENTS].get(segments[depth]) if depth < len(segments) - 1 else None
            depth += 1
    return best[2], best[3]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judged(pages: DataFrame, rules: Iterable[tuple[str, str, str]], url: str = "url", otherwise: str = "allow") -> DataFrame:
    """All columns of the rows with host, path, rule (NULL if none fits) and verdict (`otherwise` if none fits)."""
    trie = pages.sparkSession.sparkContext.broadcast(build(rules))
    address = F.coalesce(F.col(url), F.lit(""))
    kept = pages.drop("host", "path", "rule", "verdict")
    split = kept.withColumn("host", lower_ascii(F.regexp_extract(address, r"(?s)^.*?://([^/?#]*)", 1))).withColumn(
        "path", F.regexp_extract(address, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    )

    @F.pandas_udf("rule string, verdict string")
    def find(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [judge(trie.value, h, p) for h, p in zip(host, path)]
        return pd.DataFrame({"rule": [r for r, _ in found], "verdict": [v or otherwise for _, v in found]})

    return split.withColumn("_found", find("host", "path")).select("*", "_found.rule", "_found.verdict").drop("_found")
