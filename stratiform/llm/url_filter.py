"""URL allow / block rules by longest match in a broadcast trie.

The trie's edges are host labels from the right (``org``, ``example``, ``www``)
and then path segments. Walking a URL along it visits every rule that fits;
the deepest one decides, so an allow entry below a block entry wins there and
the other way round. A rule fits its host and all subdomains when the URL's
path starts with the rule's path; equal depth cannot occur twice, because a
(host, path) pair holds one entry (the last one given).

Defined results: a null URL, or one without ``://``, has an empty host and
path and fits no rule; a URL that fits none gets the default verdict; empty
tables stay empty; repeated rows are judged alike; other columns are ignored.
The rule list is the operator's parameter, and its size is checked before it
is broadcast.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules above this number are refused: the trie is held by every worker.
MAX_RULES = 2_000_000

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


class Trie:
    """Nodes are dicts. ``0`` holds a host's path trie; in a path trie the key
    ``None`` holds the entry of the path that ends with the last ``/`` and
    ``0`` the list of (prefix of the next segment, entry)."""

    def __init__(self, rules):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
        self.root: dict = {}
        for verdict, rule in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.lower().split(".") if host else []):
                node = node.setdefault(label, {})
            node = node.setdefault(0, {})
            *whole, rest = (slash + path).split("/")
            for segment in whole:
                node = node.setdefault(("/", segment), {})
            if rest:
                node.setdefault(0, {})[rest] = (rule, verdict)
            else:
                node[None] = (rule, verdict)

    def find(self, host: str, path: str):
        """Entry with the longest host, then the longest path, or None."""
        best, node = None, self.root
        pieces = path.split("/")
        for label in reversed(host.split(".") if host else []):
            node = node.get(label)
            if node is None:
                break
            if 0 in node:
                best = self._path(node[0], pieces) or best
        return best

    @staticmethod
    def _path(node: dict, pieces: list[str]):
        best = None
        for i, piece in enumerate(pieces):
            best = node.get(None, best)
            if 0 in node:
                fits = [p for p in node[0] if piece.startswith(p)]
                if fits:
                    best = node[0][max(fits, key=len)]
            if i == len(pieces) - 1:
                break
            node = node.get(("/", piece))
            if node is None:
                break
        return best


def url_parts(url):
    """Host (A-Z lowered) and path columns of a URL column."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(df: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
               default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` for every row."""
    trie = df.sparkSession.sparkContext.broadcast(Trie(list(rules)))

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def judge(host: pa.Array, path: pa.Array) -> pa.Array:
        find, seen, hits = trie.value.find, {}, []
        for pair in zip(host.to_pylist(), path.to_pylist()):
            if pair not in seen:
                seen[pair] = find(*pair)
            hits.append(seen[pair])
        return pa.StructArray.from_arrays(
            [pa.array([h and h[0] for h in hits], pa.string()),
             pa.array([h[1] if h else default for h in hits], pa.string())], ["rule", "verdict"])

    host, path = url_parts(F.col(f"`{url}`"))
    return (df.select(F.col(f"`{key}`").alias(key), host.alias("host"), path.alias("path"))
            .withColumn("_judged", judge("host", "path"))
            .select(key, "host", "path", "_judged.rule", "_judged.verdict"))


ORACLE = r"""
WITH parts AS (
  SELECT page_id,
         regexp_extract(coalesce(url, ''), '(?s)\A.*?://(.*)\z', 1) AS rest FROM pages),
hp AS (
  SELECT page_id,
         translate(regexp_extract(rest, '(?s)\A([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '(?s)\A[^/?#]*([^?#]*)', 1) AS path FROM parts),
r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM hp)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
