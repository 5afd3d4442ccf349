"""URL filters: a trie over reversed host labels and path segments.

Rules are (verdict, host, path).  A rule fits its host and all subdomains if the url's path
starts with the rule's path.  The longest rule that fits decides: that with the most host
labels, among those the one with the longest path; equal rules that disagree block.  A url
that no rule fits takes ``default``.

The rules become a trie: host labels from the right, then whole path segments, then at a
node the beginnings of a last segment (by length, so that a node of many rules costs one look-up
a length).  Up to ``TRIE_RULES`` rules of ``TRIE_CHARS`` characters in all the trie is
broadcast and every url walks it once.  A larger rule table stays distributed: distinct
urls give their few (host suffix, directory) pairs, the same trie nodes, and meet the
rules by an equi-join on the node.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

ALLOW, BLOCK = "allow", "block"

#: A broadcast trie holds at most so many rules, of so many characters in all.
TRIE_RULES = 200_000
TRIE_CHARS = 16_000_000

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_RESULT = "struct<rule:string,verdict:string>"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for
    null and for urls without ``://``.  Ports and users stay part of it."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty like ``host_of``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


class Trie:
    """Nodes are dictionaries: host labels from the right under ``hosts``, whole path segments under
    ``dirs``, and under ``rests`` the beginnings of a last segment by length, longest first."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = self._node()
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node["hosts"].setdefault(label, self._node())
            *dirs, rest = path.split("/")
            for segment in dirs:
                node = node["dirs"].setdefault(segment, self._node())
            same = node["rests"].setdefault(len(rest), {})
            if same.get(rest, (None, ALLOW))[1] != BLOCK:
                same[rest] = (host + path, verdict)
        self._longest_first(self.root)

    @staticmethod
    def _node() -> dict:
        return {"hosts": {}, "dirs": {}, "rests": {}}

    @staticmethod
    def _longest_first(root: dict) -> None:
        open_nodes = [root]
        while open_nodes:
            node = open_nodes.pop()
            node["rests"] = dict(sorted(node["rests"].items(), reverse=True))
            open_nodes += [*node["hosts"].values(), *node["dirs"].values()]

    @staticmethod
    def _in_path(node: dict, path: str) -> tuple[str, str] | None:
        """The longest path rule under a host's node."""
        best, at = None, 0
        while node is not None:
            for length, rests in node["rests"].items():
                hit = rests.get(path[at:at + length]) if at + length <= len(path) else None
                if hit:
                    best = hit
                    break
            end = path.find("/", at)
            if end < 0:
                break
            node, at = node["dirs"].get(path[at:end]), end + 1
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """``(rule, verdict)`` of the longest rule that fits, or ``None``."""
        nodes = [self.root]
        for label in reversed(host.split(".")):
            child = nodes[-1]["hosts"].get(label)
            if child is None:
                break
            nodes.append(child)
        for node in reversed(nodes):
            hit = self._in_path(node, path)
            if hit:
                return hit
        return None


def _checked(rules: Iterable[Sequence[str]]) -> list[tuple[str, str, str]]:
    out = [(v, h.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)), p) for v, h, p in rules]
    for verdict, _, path in out:
        if verdict not in (ALLOW, BLOCK) or path and not path.startswith("/"):
            raise ValueError(f"not a rule: {verdict!r}, path {path!r}")
    return out


def _by_trie(urls: DataFrame, rules: list[tuple[str, str, str]], default: str) -> DataFrame:
    trie = urls.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf(_RESULT)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            found = [trie.value.match(h, p) or (None, default) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    return urls.withColumn("__found", judged("host", "path")).select("page_id", "host", "path", "__found.rule", "__found.verdict")


def _by_join(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same verdicts from a distributed rule table."""
    directory = F.regexp_extract("path", "(?s)^(.*/)?", 1)
    nodes = rules.select(lower_ascii(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), directory.alias("r_dir"), "verdict")
    nodes = nodes.groupBy("r_host", "r_path", "r_dir").agg(F.max("verdict").alias("r_verdict"))  # block sorts after allow
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(0), F.size(labels)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".").alias("h")))
    dirs = F.transform(F.sequence(F.lit(0), F.size(segments) - 1), lambda n: F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(segments, F.lit(1), n), "/"), F.lit("/"))))
    keys = urls.select("host", "path").distinct()
    keys = keys.select("host", "path", F.explode(suffixes).alias("s"), dirs.alias("dirs")).select("host", "path", "s.n", "s.h", F.explode("dirs").alias("dir"))
    # the root node (no label) is that of rules without a host; a host without labels has it once
    keys = keys.filter("n = 0 or h <> ''")
    met = keys.join(nodes, (F.col("h") == F.col("r_host")) & (F.col("dir") == F.col("r_dir"))).filter(F.col("path").startswith(F.col("r_path")))
    best = met.groupBy(F.col("host").alias("b_host"), F.col("path").alias("b_path")).agg(
        F.max(F.struct("n", F.length("r_path").alias("len"), F.concat("r_host", "r_path").alias("rule"), "r_verdict")).alias("best"))
    out = urls.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"))


def judge(df: DataFrame, rules: Iterable[Sequence[str]] | DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = ALLOW, trie_rules: int = TRIE_RULES, trie_chars: int = TRIE_CHARS) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per row of ``df``.

    ``rules`` are (verdict, host, path) triples, or a table of these columns without nulls; a
    path is empty or begins with ``/``, a rule without host fits every host.  Null urls and urls
    without ``://`` have empty host and path; a null id stays null, repeated rows are
    judged alike, very long urls whole, further columns are not read.  No rules: every
    url takes ``default``.
    """
    urls = df.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if isinstance(rules, DataFrame):
        rules = cut_lineage(rules.select("verdict", "host", "path"))
        if not rules.filter(~F.col("verdict").isin(ALLOW, BLOCK) | ~((F.col("path") == "") | F.col("path").startswith("/"))).isEmpty():
            raise ValueError("a verdict is allow or block, a path is empty or begins with /")
        size = rules.agg(F.count("*").alias("n"), F.sum(F.length("host") + F.length("path")).alias("chars")).first()
        if size.n > trie_rules or (size.chars or 0) > trie_chars:
            return _by_join(urls, rules, default)
        rules = [tuple(r) for r in rules.collect()]
    rules = _checked(rules)
    if len(rules) > trie_rules or sum(len(h) + len(p) for _, h, p in rules) > trie_chars:
        return _by_join(urls, df.sparkSession.createDataFrame(rules, "verdict string, host string, path string"), default)
    return _by_trie(urls, rules, default)


#: The rules of ``op12``.
RULES = ((ALLOW, "org", "/"), (BLOCK, "example.org", "/es/"), (BLOCK, "example.org", "/en/1"), (ALLOW, "com", "/fr/"), (BLOCK, "com", "/de/"))

#: DuckDB SQL of ``op12``: every rule tried on every url, the longest kept.
ORACLE = r"""
WITH rules AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                     ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) t(verdict, rhost, rpath)),
u AS (SELECT row_number() OVER () AS n, page_id,
             translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path FROM pages),
m AS (SELECT u.n, max(struct_pack(a := len(string_split(rhost, '.')), b := len(rpath), rule := rhost || rpath, verdict := verdict)) AS best
      FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY u.n)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (n)
"""
