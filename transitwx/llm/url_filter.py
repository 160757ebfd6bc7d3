"""URL rules in one sorted array of 64-bit digests, mapped into memory.

The rules become a file: sorted XXH64 keys, then where each full string lies,
then the strings. Spark sends the file to every executor, each task maps it,
probes all candidates of a batch with one binary search over the keys, and
compares the full string of every hit, so that a digest collision decides
nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitwx.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Rules that may go into one mapped file (about 100 bytes each).
MAX_RULES = 20_000_000
RESULT = "host string, path string, rule string, verdict string"
VERDICTS = ("block", "allow")


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


def build_index(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The index file of ``(verdict, host, path)`` rules.

    Layout, little-endian uint64 unless said otherwise: count, number of path
    lengths, the path lengths (in characters), the sorted keys, count + 1 string
    offsets, one verdict byte per rule, the UTF-8 strings. Of rules with equal
    host and path the first one holds.
    """
    seen: dict[str, int] = {}
    for verdict, host, path in rules:
        seen.setdefault(host.translate(LOWER) + "\0" + path, VERDICTS.index(verdict))
    if len(seen) > MAX_RULES:
        raise ValueError(f"{len(seen)} rules; split lists of over {MAX_RULES}")
    order = sorted((digest(text), text) for text in seen)
    blobs = [text.encode() for _, text in order]
    lengths = sorted({len(text.partition("\0")[2]) for text in seen})
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype("<u8")
    head = np.array([len(order), len(lengths), *lengths], "<u8")
    keys = np.array([k for k, _ in order], "<u8")
    verdicts = np.array([seen[text] for _, text in order], np.uint8)
    return head.tobytes() + keys.tobytes() + offsets.tobytes() + verdicts.tobytes() + b"".join(blobs)


class Index:
    """An index file, mapped."""

    def __init__(self, path: str):
        self.data = np.memmap(path, np.uint8, mode="r")
        n, m = (int(x) for x in self.data[:16].view("<u8"))
        at = 16 + 8 * m
        self.lengths = [int(x) for x in self.data[16:at].view("<u8")]
        self.keys = self.data[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.offsets = self.data[at : at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.verdicts = self.data[at : at + n]
        self.strings = self.data[at + n :]

    def probe(self, texts: list[str]) -> np.ndarray:
        """Position of each text in the index, or -1."""
        found = np.full(len(texts), -1, np.int64)
        if not len(self.keys) or not texts:
            return found
        keys = np.fromiter((digest(t) for t in texts), np.uint64, len(texts))
        at = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys):
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == keys[i]:
                if self.strings[int(self.offsets[k]) : int(self.offsets[k + 1])].tobytes() == texts[i].encode():
                    found[i] = k
                    break
                k += 1
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:end].translate(LOWER), path[:stop]


_index: dict[str, Index] = {}


def judge(urls: pd.Series, name: str, default: str) -> pd.DataFrame:
    """Host, path, rule and verdict of a batch of urls."""
    if name not in _index:
        _index.clear()
        _index[name] = Index(SparkFiles.get(name))
    index = _index[name]
    parts = [split_url(None if pd.isna(u) else u) for u in urls]
    owner, probes = [], []
    for i, (host, path) in enumerate(parts):
        cuts = [k for k in index.lengths if k <= len(path)]
        at = 0
        while cuts:
            for k in cuts:
                owner.append(i)
                probes.append(host[at:] + "\0" + path[:k])
            dot = host.find(".", at)
            if dot < 0:
                break
            at = dot + 1
    rule: list[str | None] = [None] * len(parts)
    verdict = [default] * len(parts)
    hits = index.probe(probes)
    for p in np.flatnonzero(hits >= 0):
        i, text = owner[p], probes[p].replace("\0", "", 1)
        if rule[i] is None or len(text) > len(rule[i]):
            rule[i], verdict[i] = text, VERDICTS[int(index.verdicts[hits[p]])]
    return pd.DataFrame(
        {"host": [h for h, _ in parts], "path": [p for _, p in parts], "rule": rule, "verdict": verdict}
    )


def publish(spark: SparkSession, content: bytes) -> str:
    """Write a file below the shared folder and have Spark send it to executors."""
    path = f"{scratch_path(spark, 'urls')}.idx"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(content))
    stream.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """All columns of ``pages`` with host, path, rule and verdict.

    A rule ``(verdict, host, path)`` fits its host and all subdomains where the
    url's path starts with the rule's. Of several the longest holds (host and
    path together; they end the same host, so no two differ at one length unless
    one has the longer host: the shorter path then yields to the first probed,
    the longer host). No rule: the digest array does not know the url, and
    ``default`` is the verdict. Null, empty or scheme-less urls have empty host
    and path. Columns of the input named like a result are replaced. The list
    of rules is a given list of at most ``MAX_RULES``, not corpus data.
    """
    name = publish(pages.sparkSession, build_index(rules))
    judged = F.pandas_udf(lambda s: judge(s, name, default), RESULT)
    names = ("host", "path", "rule", "verdict")
    rest = [c for c in pages.columns if c.lower() not in names]
    return pages.withColumn("__judged", judged(F.col(url))).select(*rest, *(F.col(f"__judged.{c}").alias(c) for c in names))
