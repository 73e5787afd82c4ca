"""URL filter by a sorted digest array.

Rules are host and path prefixes.  Their 64-bit xxhash keys lie in one sorted
array; the file with that array, the rule strings and the verdicts is written
to the shared folder, Spark hands it to every executor, and each worker maps
it into memory.  A batch of urls becomes one vector of probe keys (each host
suffix with each path prefix whose length some rule has), found by binary
search and confirmed on the stored strings, so that colliding keys do no harm.  Only suffixes of as many labels
as some rule has are probed, so a very long host costs no more than its length.

Rule files are split into blocks of ``block_rules`` rules: each file is
bounded whatever the length of the list.  A worker holds no copy of it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corate.llm.common import fresh, with_columns_last
from corate.session import ensure_checkpoint_dir

RESULT = "host string, path string, rule string, verdict string"
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
_FOLD = {c: c + 32 for c in range(65, 91)}


def xxh64(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    found = _PARTS.search(url) if url is not None else None
    return (found[1].translate(_FOLD), found[2]) if found else ("", "")


def pack_rules(rules: Iterable[tuple[str, str, str]], digest: Callable[[str], int] = xxh64) -> bytes:
    """One file: counts, sorted digests, string offsets, verdict flags, strings.

    ``rules``: (verdict, host, path).  Of rules with the same host and path the
    first counts.
    """
    unique: dict[str, bool] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        unique.setdefault(host.translate(_FOLD) + path, verdict == "allow")
    keys = sorted(unique, key=lambda k: (digest(k), k))
    raw = [k.encode("utf-8", "surrogatepass") for k in keys]
    starts = np.cumsum([0, *map(len, raw)], dtype=np.int64)
    lengths = sorted({len(k) - k.find("/") if "/" in k else 0 for k in keys})
    labels = sorted({k.partition("/")[0].count(".") + 1 for k in keys})
    return b"".join([
        np.array([len(keys), len(lengths), len(labels)], np.int64).tobytes(),
        np.array([digest(k) for k in keys], np.uint64).tobytes(),
        starts.tobytes(),
        np.array(lengths, np.int64).tobytes(),
        np.array(labels, np.int64).tobytes(),
        np.array([unique[k] for k in keys], np.uint8).tobytes(),
        b"".join(raw),
    ])


class RuleFile:
    """A rule file mapped into memory."""

    def __init__(self, path: str):
        file = np.memmap(path, np.uint8, mode="r")
        n, m, p = (int(x) for x in file[:24].view(np.int64))
        at = 24
        self.digests, at = file[at : at + 8 * n].view(np.uint64), at + 8 * n
        self.starts, at = file[at : at + 8 * (n + 1)].view(np.int64), at + 8 * (n + 1)
        self.lengths, at = file[at : at + 8 * m].view(np.int64).tolist(), at + 8 * m
        self.labels, at = file[at : at + 8 * p].view(np.int64).tolist(), at + 8 * p
        self.allow, at = file[at : at + n], at + n
        self.strings = file[at:]

    def find(self, keys: list[str], digests: np.ndarray) -> list[int]:
        """The index of each key, or -1."""
        at = np.searchsorted(self.digests, digests)
        found = [-1] * len(keys)
        inside = np.flatnonzero(at < len(self.digests))
        for k in inside[self.digests[at[inside]] == digests[inside]]:
            raw, i = keys[k].encode("utf-8", "surrogatepass"), int(at[k])
            while i < len(self.digests) and self.digests[i] == digests[k]:
                if self.strings[self.starts[i] : self.starts[i + 1]].tobytes() == raw:
                    found[k] = i
                    break
                i += 1
        return found


def host_suffixes(host: str, counts: list[int]) -> list[str]:
    """The suffixes of a host of so many labels; ``counts`` ascend.  Only these can be the host of a rule."""
    found, at, labels = [], len(host), 0
    for count in counts:
        while labels < count and at >= 0:
            at, labels = host.rfind(".", 0, at), labels + 1
        if labels < count:
            break
        found.append(host[at + 1 :])
    return found


def judge_urls(urls: Iterable[str | None], files: list[RuleFile], default: str, digest: Callable[[str], int] = xxh64) -> pd.DataFrame:
    parts = [split_url(u) for u in urls]
    best: list[tuple[tuple[int, int], str, str] | None] = [None] * len(parts)
    for file in files:
        row, keys = [], []
        for k, (host, path) in enumerate(parts):
            if not host and not path:
                continue
            suffixes = host_suffixes(host, file.labels)
            for size in file.lengths:
                if size <= len(path):
                    keys += [s + path[:size] for s in suffixes]
                    row += [k] * len(suffixes)
        distinct = list(dict.fromkeys(keys))
        hits = dict(zip(distinct, file.find(distinct, np.array([digest(k) for k in distinct], np.uint64)), strict=True))
        for k, key in zip(row, keys, strict=True):
            if (i := hits[key]) >= 0:
                rank = (len(key), len(key.partition("/")[0]))
                if best[k] is None or rank > best[k][0]:
                    best[k] = (rank, key, "allow" if file.allow[i] else "block")
    return pd.DataFrame({
        "host": [p[0] for p in parts],
        "path": [p[1] for p in parts],
        "rule": [b[1] if b else None for b in best],
        "verdict": [b[2] if b else default for b in best],
    })


def share_file(spark: SparkSession, data: bytes, kind: str) -> str:
    """Write bytes to the shared folder and have Spark hand them to all executors.

    Executors that start later, for a lost one, fetch the file too.
    """
    sc = spark.sparkContext
    name = f"{kind}-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{name}")
    system = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not system.exists(path):
        out = system.create(path)
        out.write(bytearray(data))
        out.close()
    sc.addFile(system.makeQualified(path).toString())
    return name


@lru_cache(maxsize=64)
def _mapped(name: str) -> RuleFile:
    return RuleFile(SparkFiles.get(name))


def filter_urls(
    df: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    url_col: str = "url",
    default: str = "allow",
    block_rules: int = 1_000_000,
) -> DataFrame:
    """Add host, path, rule and verdict to ``df``.

    A rule (verdict, host, path) fits its host and all subdomains if the url's
    path starts with the rule's.  The longest fitting rule wins, at equal
    length the one with the longer host.  Without a fitting rule ``rule`` is
    null and ``verdict`` is ``default``; so it is for a null url, an empty one
    or one without ``://``.  Input columns named like the results are replaced.
    """
    rules = list(rules)
    blocks = [rules[i : i + block_rules] for i in range(0, len(rules), block_rules)]
    names = [share_file(df.sparkSession, pack_rules(b), "url-rules") for b in blocks]

    @F.pandas_udf(RESULT)
    def judge(urls: pd.Series) -> pd.DataFrame:
        return judge_urls((u if isinstance(u, str) else None for u in urls), [_mapped(n) for n in names], default)

    name = fresh("_judged", df)
    judged = df.withColumn(name, judge(F.col(url_col)))
    columns = {c: F.col(f"{name}.{c}") for c in ("host", "path", "rule", "verdict")}
    return with_columns_last(judged, columns).drop(name)
