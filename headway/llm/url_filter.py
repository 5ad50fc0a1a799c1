"""URL filter: a trie over reversed host labels and path segments.

The rule list is an operator parameter (a curated list); its size is checked
before it is broadcast.  Every url walks the trie once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest rule list (characters of all rules) that may be broadcast.
MAX_RULE_CHARS = 256_000_000
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Rule(NamedTuple):
    host: str    # 'example.net': fits this host and all its subdomains
    path: str    # '/en/': the url's path has to start with it
    action: str  # 'allow' or 'block'


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ``://``; both empty if there is none."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    cut = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(ASCII_LOWER), path


class Trie:
    """Nodes are dicts: host labels from the right, then whole path segments.
    A rule ends at the node of its last whole segment, under the text that
    has to start the next one (empty for a rule that ends in ``/``)."""

    def __init__(self, rules: list[Rule]):
        self.root: dict = {}
        for r in rules:
            node = self.root
            for label in reversed(r.host.split(".")):
                node = node.setdefault(("h", label), {})
            segments = r.path.split("/")
            if len(segments) > 1:
                for s in segments[:-1]:
                    node = node.setdefault(("p", s), {})
            ends = node.setdefault("ends", {})
            old = ends.get(segments[-1])
            if old is None or r.action == "block":  # the same place twice: block
                ends[segments[-1]] = r

    def match(self, host: str, path: str) -> Rule | None:
        """The longest rule (characters of host and path) that fits; of two
        equally long ones the one with the longer host."""
        best, key = None, (-1, -1)
        segments = path.split("/")
        node = self.root
        for label in reversed(host.split(".")):
            node = node.get(("h", label))
            if node is None:
                break
            at = node
            for s in segments:
                for start, r in at.get("ends", {}).items():
                    k = (len(r.host) + len(r.path), len(r.host))
                    if k > key and s.startswith(start):
                        best, key = r, k
                at = at.get(("p", s))
                if at is None:
                    break
        return best


OUT = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("verdict", T.StringType()),
])


def judge(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule (host + path of the longest fitting rule, else
    null) and verdict (the rule's action, else ``default``).

    A null url, an empty one and one without ``://`` have an empty host and
    path and get the default.  Repeated rows are judged alike and all stay;
    an empty table gives an empty table; input columns called like an output
    column, in any case, are replaced (``__judged`` is reserved).
    """
    size = sum(len(r.host) + len(r.path) for r in rules)
    if size > MAX_RULE_CHARS:
        raise ValueError(f"{size} characters of rules: too many to broadcast")
    trie = df.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.arrow_udf(OUT)
    def verdicts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = trie.value
        for urls in batches:
            hosts, paths, names, verdict = [], [], [], []
            for u in urls.to_pylist():
                host, path = split_url(u)
                r = t.match(host, path)
                hosts.append(host)
                paths.append(path)
                names.append(r and r.host + r.path)
                verdict.append(r.action if r else default)
            cols = [pa.array(x, pa.string()) for x in (hosts, paths, names, verdict)]
            yield pa.StructArray.from_arrays(cols, ["host", "path", "rule", "verdict"])

    keep = [c for c in df.columns if c.lower() not in OUT.names]
    judged = df.select(*[F.col(f"`{c}`") for c in keep], verdicts(F.col(f"`{url}`")).alias("__judged"))
    return judged.select(*[F.col(f"`{c}`") for c in keep], "__judged.*")
