"""URL filter: a trie over reversed host labels and path segments, longest match first."""

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import broadcast, opened

SEPARATORS = "[/?#]"


@dataclass
class Node:
    """A place in the trie. ``labels`` lead on in the host, ``segments`` in the path."""

    labels: dict = field(default_factory=dict)
    segments: dict = field(default_factory=dict)
    rules: list = field(default_factory=list)  # (last unfinished segment, rule, verdict)


def split_rule(rule: str) -> tuple[str, str]:
    """``host/path`` as (host, path); the path keeps its slash, and is '/' if none is given."""
    host, _, path = rule.partition("/")
    return host.lower(), "/" + path


def build_trie(rules) -> Node:
    """A trie of (verdict, ``host/path``) entries.

    A host leads from the top-level label down; then whole path segments follow. What the rule
    has after its last slash need not be a whole segment and is kept as a prefix. Of two equal
    rules the block entry counts.
    """
    root = Node()
    for verdict, rule in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"{verdict!r} is neither allow nor block")
        host, path = split_rule(rule)
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node.labels.setdefault(label, Node())
        *whole, rest = path[1:].split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        node.rules.append((rest, rule, verdict))
    return root


def judge(trie: Node, host: str, path: str):
    """(rule, verdict) of the longest rule that fits, else (None, None).

    Longer hosts come before shorter ones, then longer paths; a block entry wins a tie.
    """
    if not path.startswith("/") or not host:
        return None, None
    hosts, node = [], trie
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        hosts.append(node)
    segments = path[1:].split("/")
    for node in reversed(hosts):
        best = None
        for i, segment in enumerate(segments):
            # Whole segments so far have matched; the rest of the path starts with `segment`.
            rest = None
            for tail, rule, verdict in node.rules:
                if tail and "/" not in tail and not segment.startswith(tail):
                    continue
                found = (i, len(tail), verdict == "block", rule, verdict)
                if rest is None or found[:3] > rest[:3]:
                    rest = found
            best = rest or best
            node = node.segments.get(segment) if i < len(segments) - 1 else None
            if node is None:
                break
        if best:
            return best[3], best[4]
    return None, None


def url_parts(column):
    """(host, path) expressions: what follows the first ``://`` up to its separators."""
    url = F.coalesce(column, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def _rank(rule, verdict):
    """Of two rules that fit one url the higher counts: their hosts and paths are of one chain."""
    host, path = split_rule(rule)
    return len(host), len(path), verdict == "block"


def _judged(shared):
    """Fills rule and verdict where the trie has a rule of higher rank than the one there."""
    def run(batches):
        trie = opened(shared)
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist()
                              for c in ("host", "path", "rule", "verdict"))))
            known = {}
            for row in set(rows):
                found = judge(trie, *row[:2])
                better = found[0] is not None and (
                    row[2] is None or _rank(*found) > _rank(*row[2:]))
                known[row] = found if better else row[2:]
            rule, verdict = (pa.array([known[r][i] for r in rows], pa.string()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], rule, verdict],
                                             batch.schema.names)
    return run


def filter_urls(pages: DataFrame, rules, url="url", keep=("page_id",), default="allow",
                block_rules=200_000) -> DataFrame:
    """``keep`` columns, host, path, rule (NULL if none fits) and verdict of every url.

    NULL urls and those without ``://`` have an empty host and path and get ``default``. Equal
    urls get equal rows; row order and count stay. Rules are a list, of any length, in the
    driver. Their trie is broadcast in blocks of ``block_rules`` entries, which bounds each; every
    further block is a further pass over the urls, in which rules of higher rank replace those
    found before. Rules without a host fit nothing. Columns of ``pages`` called host, path, rule
    or verdict do not disturb: only ``keep`` and the url are read.
    """
    rules = list(rules)
    spark = pages.sparkSession
    host, path = url_parts(F.col(url).cast("string"))
    kinds = dict(pages.dtypes)
    clash = {"host", "path", "rule", "verdict"} & {k.lower() for k in keep}
    if clash:
        raise ValueError(f"keep has names of result columns: {sorted(clash)}")
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "host string", "path string",
                        "rule string", "verdict string"])
    none = F.lit(None).cast("string")
    out = pages.select(*keep, host.alias("host"), path.alias("path"), none.alias("rule"),
                       none.alias("verdict"))
    for low in range(0, len(rules), block_rules):
        out = out.mapInArrow(_judged(broadcast(spark, build_trie(rules[low:low + block_rules]))),
                             schema)
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
