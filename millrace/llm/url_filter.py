"""URL filter: a trie over reversed host labels and path segments; the longest entry wins."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from .common import map_batches

#: Entries that may be broadcast.  A longer list belongs in a table joined by host.
MAX_ENTRIES = 2_000_000


@dataclass
class _Node:
    children: dict[str, "_Node"] = field(default_factory=dict)
    #: Where paths of this host begin.
    path: "_Node | None" = None
    #: Rests of a last, unfinished segment: (rest, rule, verdict).
    ends: list[tuple[str, str, str]] = field(default_factory=list)


class UrlTrie:
    """Entries are ``(verdict, "host/path")``.  An entry fits its host and all subdomains when the
    url's path starts with the entry's path (which begins at the first ``/``)."""

    def __init__(self, entries: Iterable[tuple[str, str]]):
        self.root = _Node()
        for n, (verdict, rule) in enumerate(entries):
            if n >= MAX_ENTRIES:
                raise ValueError(f"more than {MAX_ENTRIES} entries are too many to broadcast")
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r}: allow or block")
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.lower().split(".")) if host else ():
                node = node.children.setdefault(label, _Node())
            if not slash:
                node.ends.append(("", rule, verdict))
                continue
            node.path = node.path or _Node()
            node, (*whole, rest) = node.path, path.split("/")
            for segment in whole:
                node = node.children.setdefault(segment, _Node())
            node.ends.append((rest, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule and verdict of the entry that fits with the most host labels, and of those
        the one with the longest path; of equal entries a block wins."""
        best, node = None, self.root
        segments = path[1:].split("/") if path.startswith("/") else None
        labels = reversed(host.split(".")) if host else iter(())
        while True:
            best = self._of_host(node, segments) or best
            label = next(labels, None)
            if label is None or (node := node.children.get(label)) is None:
                return best

    @staticmethod
    def _of_host(node: _Node, segments: list[str] | None) -> tuple[str, str] | None:
        found = [(0, -1, verdict == "block", rule, verdict) for _, rule, verdict in node.ends]
        if segments is not None and (at := node.path):
            for depth, segment in enumerate(segments):
                found += [(depth + 1, len(rest), verdict == "block", rule, verdict)
                          for rest, rule, verdict in at.ends if segment.startswith(rest)]
                if (at := at.children.get(segment)) is None:
                    break
        return max(found)[3:] if found else None


def filter_urls(urls: DataFrame, entries: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Host, path, winning rule and verdict of every url.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case.  Path: from
    there up to ``?``, ``#`` or the end.  A null url, or one without ``://``, has an empty host and
    path.  Without a fitting entry the rule is null and the verdict is ``default``.  Repeated rows
    are judged one by one; other columns are not read.

    The trie is broadcast; its size is bounded by ``MAX_ENTRIES``.
    """
    trie = urls.sparkSession.sparkContext.broadcast(UrlTrie(entries))

    def make():
        find, memory = trie.value.find, {}

        def judge(batch):
            out = {"id": batch["id"], "rule": [], "verdict": []}
            for host, path in zip(batch["host"], batch["path"]):
                if (host, path) not in memory:
                    if len(memory) > 10_000:
                        memory.clear()
                    memory[host, path] = find(host, path) or (None, default)
                rule, verdict = memory[host, path]
                out["rule"].append(rule)
                out["verdict"].append(verdict)
            return out | {"host": batch["host"], "path": batch["path"]}
        return judge

    url = F.coalesce(F.col(url_col), F.lit(""))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    parts = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    kind = dict(urls.dtypes)[id_col]
    out = map_batches(parts, make, f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)
