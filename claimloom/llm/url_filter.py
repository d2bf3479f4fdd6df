"""URL filter: allow and block entries in one trie, the longest match decides.

The trie branches on host labels from the last to the first, then on path
segments.  It is broadcast; ``MAX_RULE_BYTES`` bounds its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULE_BYTES = 64 * 1024 * 1024


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nested dicts: ``hosts`` by label, ``paths`` by segment, ``ends`` by the beginning of a last segment.

    A rule fits its host and every subdomain, and every path that begins with
    its path.  Of an allow and a block entry for the same place, allow counts.
    """
    if sum(len(r.text.encode()) + 64 for r in rules) > MAX_RULE_BYTES:
        raise ValueError(f"the rules take more than {MAX_RULE_BYTES} bytes")
    root: dict = {}
    for rule in rules:
        if rule.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict: {rule.verdict}")
        node = root
        for label in reversed(rule.host.split(".")) if rule.host else ():
            node = node.setdefault("hosts", {}).setdefault(label, {})
        *whole, end = rule.path.split("/")
        for segment in whole:
            node = node.setdefault("paths", {}).setdefault(segment, {})
        ends = node.setdefault("ends", {})
        if rule.verdict == "allow" or end not in ends:
            ends[end] = (rule.text, rule.verdict)
    return root


def _by_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
    best = None
    for segment in segments:
        ends = node.get("ends")
        if ends:
            fits = [e for e in ends if segment.startswith(e)] if len(ends) < 16 else [
                segment[:n] for n in range(len(segment) + 1) if segment[:n] in ends
            ]
            if fits:
                best = ends[max(fits, key=len)]
        node = node.get("paths", {}).get(segment)
        if node is None:
            break
    return best


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the fitting entry with most host labels, then with the longest path."""
    segments = path.split("/")
    best = _by_path(trie, segments)
    node = trie
    for label in reversed(host.split(".")):
        node = node.get("hosts", {}).get(label)
        if node is None:
            break
        best = _by_path(node, segments) or best
    return best


def judge(df: DataFrame, rules: Sequence[Rule], url: str = "url", keep: Sequence[str] = (), otherwise: str = "allow") -> DataFrame:
    """``keep`` columns, host, path, rule and verdict of every row.

    A url that is null or has no ``://`` has an empty host and path.  A url no
    entry fits gets a null rule and the verdict ``otherwise``.  Other columns
    are dropped, so their names cannot clash; repeated rows are judged alike.
    """
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [longest_match(trie.value, h, p) or (None, otherwise) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    placed = df.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    return placed.withColumn("_m", match("host", "path")).select(*keep, "host", "path", "_m.rule", "_m.verdict")
