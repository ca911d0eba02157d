"""URL allow and block lists: a trie over reversed host labels, then path segments.

A rule is a host and a path prefix, written ``host/path``. It fits its host and every subdomain when the URL's path
starts with the rule's path. The deepest host wins, then the longest path; of two entries for one place, block wins.

Cases: a null URL, or one without ``://``, has an empty host and path and gets the default verdict. Rows repeat as given. A URL
of any length is walked once, no deeper than the deepest rule. More than 1,000,000 rules are an error.
An empty table gives an empty result. Columns of the input other than the URL pass through; one named like a result
column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MAX_RULES = 1_000_000  # the trie is broadcast; more rules are an error, never a cut


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path, both empty if there is no ``://``."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "?#":
        cut = rest.find(mark)
        if cut >= 0:
            rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.encode().lower().decode(), path  # bytes.lower() touches A-Z only


class UrlTrie:
    """Rules by host label from the right, then by path segment."""

    def __init__(self, allow: Iterable[str] = (), block: Iterable[str] = ()):
        self.root: dict = {"hosts": {}, "paths": None}
        self.size = 0
        for verdict, rules in (("allow", allow), ("block", block)):
            for rule in rules:
                self._add(rule, verdict)

    def _add(self, rule: str, verdict: str) -> None:
        host, slash, path = rule.partition("/")
        node = self.root
        for label in reversed(host.encode().lower().decode().split(".")):
            node = node["hosts"].setdefault(label, {"hosts": {}, "paths": None})
        node["paths"] = place = node["paths"] or {"next": {}, "ends": {}}
        *whole, last = (slash + path).split("/")
        for segment in whole:
            place = place["next"].setdefault(segment, {"next": {}, "ends": {}})
        place["ends"][last] = (rule, verdict)  # block entries come last and win
        self.size += 1
        if self.size > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules")

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule and verdict of the longest match, or None."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node["hosts"].get(label)
            if node is None:
                break
            if node["paths"]:
                best = self._longest(node["paths"], path) or best
        return best

    @staticmethod
    def _longest(place: dict, path: str) -> tuple[str, str] | None:
        best = None
        for segment in path.split("/"):
            ends = place["ends"]
            if ends:  # the last segment of a rule need only begin the URL's segment
                best = next((ends[segment[:n]] for n in range(len(segment), -1, -1) if segment[:n] in ends), best)
            place = place["next"].get(segment)
            if place is None:
                break
        return best


def filter_urls(df: DataFrame, allow, block, url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` of each URL. No shuffle."""
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(allow, block))
    added = ["host", "path", "rule", "verdict"]
    keep = [f for f in df.schema.fields if f.name not in added]
    schema = T.StructType(keep + [T.StructField(n, T.StringType()) for n in added])
    names = [f.name for f in keep]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = trie.value
        for batch in batches:
            found = {n: [] for n in added}
            for text in batch.column(names.index(url)).to_pylist():
                host, path = split_url(text)
                rule, verdict = rules.match(host, path) or (None, default)
                for n, v in zip(added, (host, path, rule, verdict)):
                    found[n].append(v)
            arrays = [*batch.columns, *[pa.array(found[n], pa.string()) for n in added]]
            yield pa.RecordBatch.from_arrays(arrays, names=names + added)

    return df.select(*[f"`{n}`" for n in names]).mapInArrow(judge, schema)
