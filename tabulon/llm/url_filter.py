"""URL filter over a sorted array of 64-bit digests.

A rule list is packed into one file: the sorted xxhash64 keys of the rules' strings
(host and path), their offsets, their verdicts, and the strings themselves. Spark hands
the file to every executor (``addFile``), where tasks map it into memory. Each url's host
suffixes and path prefixes are hashed and found by one vectorised binary search per
batch; a key that is found counts only if the stored string is the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabulon.llm.common import ascii_lower, table
from tabulon.session import shared_path

#: Rows probed together.
ROWS_AT_ONCE = 4096


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; empty without."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def pack_rules(rules: Sequence[tuple[str, str, str]]) -> bytes:
    """The file's bytes for (host, path, verdict) rules; of equal rules the last counts.

    Layout, little-endian: number of rules, most labels of a rule's host, number of
    distinct path lengths (three uint64); the path lengths; sorted keys; string offsets (one more than
    rules); verdict numbers (all uint64); verdict names joined by newlines, padded by
    their length in front; strings.
    """
    rules = [(h.encode().lower().decode(), p, v) for h, p, v in rules]  # A-Z only, as in host_of
    last = {h + p: (len(p), v) for h, p, v in rules}
    labels_most = max((h.count(".") + 1 for h, _, _ in rules), default=0)
    names = sorted({v for _, v in last.values()})
    rows = sorted((xxhash.xxh64_intdigest(s.encode()), s.encode(), n, names.index(v)) for s, (n, v) in last.items())
    lengths = sorted({n for _, _, n, _ in rows})
    head = np.array([len(rows), labels_most, len(lengths), *lengths], "<u8")
    keys = np.array([r[0] for r in rows], "<u8")
    offsets = np.cumsum([0] + [len(r[1]) for r in rows]).astype("<u8")
    verdicts = np.array([r[3] for r in rows], "<u8")
    labels = "\n".join(names).encode()
    return b"".join([head.tobytes(), keys.tobytes(), offsets.tobytes(), verdicts.tobytes(),
                     np.array([len(labels)], "<u8").tobytes(), labels, *[r[1] for r in rows]])


class DigestArray:
    """A packed rule list, mapped into memory."""

    def __init__(self, path: str):
        words = np.memmap(path, "u1", "r")
        n, self.labels_most, k = (int(x) for x in words[:24].view("<u8"))
        at = 24

        def take(count: int) -> np.ndarray:
            nonlocal at
            out = words[at:at + 8 * count].view("<u8")
            at += 8 * count
            return out

        self.lengths = [int(x) for x in take(k)]
        self.keys, self.offsets, self.verdicts = take(n), take(n + 1), take(n)
        size = int(take(1)[0])
        self.names = bytes(words[at:at + size]).decode().split("\n")
        self.strings = words[at + size:]

    def candidates(self, host: str, path: str) -> list[str]:
        """Every host suffix with every path prefix that a rule could have, longest first."""
        labels = host.split(".")
        first = max(0, len(labels) - self.labels_most)
        hosts = [".".join(labels[i:]) for i in range(first, len(labels))] if host else []
        prefixes = [path[:n] for n in self.lengths if n <= len(path)]
        return sorted((h + p for h in hosts for p in prefixes), key=len, reverse=True)

    def judge(self, hosts: Sequence[str], paths: Sequence[str]) -> list[tuple[str, str] | None]:
        """For each url the longest rule that fits and its verdict."""
        out: list[tuple[str, str] | None] = [None] * len(hosts)
        owner, tried = [], []
        for i, (h, p) in enumerate(zip(hosts, paths)):
            found = self.candidates(h, p)
            owner += [i] * len(found)
            tried += found
        if not tried or not len(self.keys):
            return out
        digests = np.fromiter((xxhash.xxh64_intdigest(t.encode()) for t in tried), "<u8", len(tried))
        first = np.searchsorted(self.keys, digests, "left")
        there = first < len(self.keys)
        there[there] = self.keys[first[there]] == digests[there]
        for c in np.flatnonzero(there):
            i, at, want = owner[c], int(first[c]), tried[c].encode()
            while out[i] is None and at < len(self.keys) and self.keys[at] == digests[c]:
                if bytes(self.strings[int(self.offsets[at]):int(self.offsets[at + 1])]) == want:
                    out[i] = tried[c], self.names[int(self.verdicts[at])]
                at += 1
        return out


def publish(spark: SparkSession, data: bytes) -> str:
    """Write the packed list to the shared folder and have Spark copy it to executors;
    returns the name it has there."""
    name = f"digests-{uuid.uuid4().hex}.bin"
    target = spark._jvm.org.apache.hadoop.fs.Path(shared_path(spark, "llm", "url_rules", name))
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    spark.sparkContext.addFile(target.toString())
    return name


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow",
               url_col: str = "url", keep: Sequence[str] = ("page_id",), max_rules: int = 5_000_000) -> DataFrame:
    """One row per input row: the ``keep`` columns, host, path, rule (NULL if none fits)
    and verdict (``default`` where no rule fits).

    A rule fits its host and all subdomains if the path starts with the rule's path; the
    longest rule wins. The list passes through the driver, which is why it has a bound.
    A NULL url or one without ``://`` has an empty host and path and fits no rule.
    Rows are independent: repeated rows get repeated results. A ``keep`` column named
    like a result is replaced by it.
    """
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; max_rules allows {max_rules}")
    spark = pages.sparkSession
    name = publish(spark, pack_rules(rules))
    keep = [c for c in keep if c not in ("host", "path", "rule", "verdict")]
    url = F.col(f"`{url_col}`")
    src = pages.select(*[F.col(f"`{c}`") for c in keep], host_of(url).alias("host"), path_of(url).alias("path"))
    text = [StructField(c, StringType()) for c in ("rule", "verdict")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = DigestArray(SparkFiles.get(name))
        k = len(keep)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                got = digests.judge(part.column(k).to_pylist(), part.column(k + 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([g and g[0] for g in got], pa.string()),
                     pa.array([g[1] if g else default for g in got], pa.string())],
                    names=[*keep, "host", "path", "rule", "verdict"])

    return src.mapInArrow(run, StructType([*src.schema.fields, *text]))


#: Fixed values of the contract: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


OP8_SQL = r"""
with r(rhost, rpath, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
hosts as (select distinct host, path from p),
best as (
  select host, path, arg_max(rhost || rpath, length(rhost || rpath)) as rule,
         arg_max(verdict, length(rhost || rpath)) as verdict
  from hosts join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by host, path)
select page_id, p.host, p.path, rule, coalesce(verdict, 'allow') as verdict
from p left join best on p.host = best.host and p.path = best.path
"""
