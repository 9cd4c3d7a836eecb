"""URL allow and block rules in a sorted, memory-mapped digest array.

A rule is a host and a path prefix, written together (``example.com/en/``).  The
rules' 64-bit xxhash keys lie sorted in one file, with the full strings behind
them.  The driver ships the file to each executor once; workers map it, so the
pages are shared between the workers of a machine.  A batch of URLs turns into one
array of probes (every host suffix at a label, with every path prefix of a length
that some rule has), which one vectorised binary search resolves; a hit counts
only if the stored string equals the probe.
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (rule, verdict) of the registered query.
RULES = (
    ("com/en/", "block"),
    ("example.com/en/7", "allow"),
    ("net/de/", "allow"),
    ("example.net/de/8", "block"),
    ("org/es/", "block"),
)
#: The rule file is shipped whole to each executor, so its size is bounded (bytes).
MOST_BYTES = 2_000_000_000
SCHEMA = "page_id long, host string, path string, rule string, verdict string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def build(rules: Sequence[tuple[str, str]]) -> bytes:
    """The file: counts, sorted keys, string offsets, verdicts, path lengths, strings.

    A rule given with both verdicts blocks.
    """
    best: dict[str, int] = {}
    for rule, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r} of {rule!r}")
        host, path = split_rule(rule)
        best[host + path] = max(best.get(host + path, 0), int(verdict == "block"))
    names = sorted(best, key=lambda s: (xxhash.xxh64_intdigest(s), s))
    blob = [s.encode() for s in names]
    keys = np.array([xxhash.xxh64_intdigest(b) for b in blob], "<u8")
    ends = np.cumsum([0, *map(len, blob)]).astype("<i8")
    block = np.array([best[s] for s in names], "<u1")
    lengths = np.array(sorted({len(split_rule(s)[1]) for s in names}), "<i8")
    parts = (struct.pack("<qq", len(names), len(lengths)), keys, ends, lengths, block, b"".join(blob))
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in parts)


class RuleIndex:
    """The mapped file."""

    def __init__(self, path: str):
        n, m = np.fromfile(path, "<i8", 2)
        at = 16

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.memmap(path, kind, "r", at, (count,)) if count else np.zeros(0, kind)
            at += out.nbytes
            return out

        self.keys, self.ends, lengths, self.block = part("<u8", n), part("<i8", n + 1), part("<i8", m), part("<u1", n)
        self.lengths = lengths.tolist()
        self.blob = part("<u1", int(self.ends[-1]))

    def find(self, probes: list[str]) -> np.ndarray:
        """Row of each probe in the index, -1 where it is not there."""
        out = np.full(len(probes), -1, "<i8")
        if not probes or not len(self.keys):
            return out
        keys = np.array([xxhash.xxh64_intdigest(p) for p in probes], "<u8")
        at = np.searchsorted(self.keys, keys)
        hits = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys))
        for i in hits.tolist():
            want, k = probes[i].encode(), int(at[i])
            while k < len(self.keys) and self.keys[k] == keys[i]:  # rules with one key lie side by side
                if self.blob[self.ends[k] : self.ends[k + 1]].tobytes() == want:
                    out[i] = k
                    break
                k += 1
        return out

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[bool]]:
        """The longest rule that fits each URL, or None, and whether it blocks.

        Of equally long rules the one with the longer host wins.
        """
        probes, owner, host_len = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            suffixes, dot = [host], host.find(".")
            while dot >= 0:
                suffixes.append(host[dot + 1 :])
                dot = host.find(".", dot + 1)
            for n in self.lengths:
                if n <= len(path):
                    prefix = path[:n]
                    for s in suffixes:
                        probes.append(s + prefix)
                        owner.append(i)
                        host_len.append(len(s))
        rules: list[str | None] = [None] * len(hosts)
        block, best = [False] * len(hosts), [(-1, -1)] * len(hosts)
        found = self.find(probes)
        for j in np.flatnonzero(found >= 0).tolist():
            i, rank = owner[j], (len(probes[j]), host_len[j])
            # the host of a rule ends before its first slash, so a probe must be cut where its rule is
            if rank > best[i] and split_rule(probes[j])[0] == probes[j][: host_len[j]]:
                best[i], rules[i], block[i] = rank, probes[j], bool(self.block[found[j]])
        return rules, block


@functools.lru_cache(maxsize=2)
def _mapped(name: str) -> RuleIndex:
    return RuleIndex(SparkFiles.get(name))


def ship(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> str:
    """Build the file and hand it to the executors; returns its name."""
    data = build(rules)
    if len(data) > MOST_BYTES:
        raise ValueError(f"{len(data)} bytes of rules; the file is shipped to each executor and limited to {MOST_BYTES}")
    name = f"url-rules-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    if not any(x.endswith(name) for x in spark.sparkContext.listFiles):
        path = os.path.join(tempfile.mkdtemp(prefix="url-rules-"), name)
        with open(path, "wb") as f:
            f.write(data)
        spark.sparkContext.addFile(path)
    return name


def _judged(batches: Iterator[pa.RecordBatch], name: str, default: str) -> Iterator[pa.RecordBatch]:
    index = _mapped(name)
    for batch in batches:
        rules, block = index.judge(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        verdicts = [default if r is None else "block" if b else "allow" for r, b in zip(rules, block, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            ["page_id", "host", "path", "rule", "verdict"],
        )


def url_filter(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    default: str = "allow",
    *,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest that fits gives the verdict, else ``default`` does.  A null URL, or
    one without ``://``, has an empty host and path and takes the default.  Repeated
    rows give a row each; null ids are carried; further columns are ignored.
    """
    name = ship(pages.sparkSession, rules)
    urls = pages.select(
        F.col(id_col).cast("long").alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    return urls.mapInArrow(lambda b: _judged(b, name, default), SCHEMA)
