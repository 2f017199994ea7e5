"""URL filtering by a sorted digest array.

Rules are ``host/path-prefix`` strings with a verdict.  The driver hashes every
rule to a 64-bit xxhash key, sorts the keys and writes one file: keys, verdicts,
string offsets, strings.  The file is a stated list, not corpus data; it lies in
the shared folder and goes to the executors through ``SparkContext.addFile``,
which also serves executors that join later.  Each worker memory-maps it, probes all candidate keys of a
batch with one vectorised binary search and confirms hits against the stored
strings, so two strings with one digest are never confused.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from .common import ascii_lower, shared_dir, table, tidy

MAGIC = b"SDA1"
#: The query's rules: (host and path prefix, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Verdict of a url that no rule fits: it is in no list.
DEFAULT_VERDICT = "allow"
VERDICTS = ("allow", "block")


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def digest_bytes(rules) -> bytes:
    """The file's content. Keys ascending; equal digests of different strings stand side by side. A rule given twice counts as last given."""
    rows = sorted((digest(k), k.encode("utf-8", "surrogatepass"), VERDICTS.index(v)) for k, v in dict(rules).items())
    lengths = sorted({len(k) - k.index("/") for k, _ in dict(rules).items()})
    ends = np.cumsum([len(r[1]) for r in rows], dtype="<u8") if rows else np.zeros(0, "<u8")
    parts = [
        MAGIC + struct.pack("<III", len(rows), len(lengths), 0),
        np.array([r[0] for r in rows], "<u8").tobytes(),
        np.concatenate([[0], ends]).astype("<u8").tobytes(),
        np.array(lengths, "<u8").tobytes(),
        np.array([r[2] for r in rows], np.uint8).tobytes(),
        *(r[1] for r in rows),
    ]
    return b"".join(parts)


def publish_digests(spark: SparkSession, rules) -> str:
    """Name under which executors find the file: written to the shared folder and added to the session's files."""
    name = f"digests-{uuid.uuid4().hex}.sda"
    target = f"{shared_dir(spark)}/tabularium/{name}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(digest_bytes(rules)))
    finally:
        out.close()
    spark.sparkContext.addFile(target)
    return name


class DigestArray:
    """The memory-mapped file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            head = f.read(16)
        if head[:4] != MAGIC:
            raise ValueError("not a digest array")
        n, m, _ = struct.unpack("<III", head[4:])
        at = 16
        self.raw = raw = np.memmap(path, np.uint8, "r")
        self.keys = raw[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.ends = raw[at : at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.lengths = raw[at : at + 8 * m].view("<u8").astype(int).tolist()
        at += 8 * m
        self.verdicts = raw[at : at + n]
        self.strings = at + n

    def string(self, i: int) -> bytes:
        return self.raw[self.strings + int(self.ends[i]) : self.strings + int(self.ends[i + 1])].tobytes()

    def probe(self, candidates: list[str]) -> np.ndarray:
        """The row of each candidate, -1 where the array lacks it."""
        found = np.full(len(candidates), -1, np.int64)
        if not len(self.keys) or not candidates:
            return found
        want = np.array([digest(c) for c in candidates], "<u8")
        at = np.searchsorted(self.keys, want)
        inside = at < len(self.keys)
        hits = np.nonzero(inside)[0]
        hits = hits[self.keys[at[hits]] == want[hits]]
        for i in hits:
            text, j = candidates[i].encode("utf-8", "surrogatepass"), int(at[i])
            while j < len(self.keys) and self.keys[j] == want[i]:
                if self.string(j) == text:
                    found[i] = j
                    break
                j += 1
        return found


def candidates(host: str, path: str, lengths: list[int]):
    """Rule strings that would fit, longest first: the host and each parent domain, each with the path prefixes of the lengths in use."""
    labels = host.split(".")
    for cut in range(len(labels)):
        suffix = ".".join(labels[cut:])
        for n in lengths:
            if n <= len(path):
                yield len(suffix) + n, suffix + path[:n]


def host_and_path(url):
    """Host and path of the column named ``url``: null urls and urls without ``://`` have both empty."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(F.col(url), start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def judge_urls(pages: DataFrame, rules=RULES, *, default: str = DEFAULT_VERDICT, url: str = "url", key: str = "page_id") -> DataFrame:
    """key, host, path, rule, verdict for every row of ``pages``; ``rule`` is null where none fits.

    The longest fitting rule wins; of equally long ones, that of the longer host.
    """
    name = publish_digests(pages.sparkSession, rules)

    def judge(batches):
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            at, probes, sizes = [], [], []
            for i, (h, p) in enumerate(zip(hosts, paths)):
                for size, c in candidates(h, p, array.lengths):
                    at.append(i)
                    probes.append(c)
                    sizes.append(size)
            rows = array.probe(probes)
            best: dict[int, tuple] = {}
            for k in np.nonzero(rows >= 0)[0]:
                host_chars = probes[k].index("/") if "/" in probes[k] else 0
                mark = (sizes[k], host_chars, probes[k], int(rows[k]))
                if mark > best.get(at[k], (-1,)):
                    best[at[k]] = mark
            rule = [best[i][2] if i in best else None for i in range(len(hosts))]
            verdict = [VERDICTS[array.verdicts[best[i][3]]] if i in best else default for i in range(len(hosts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    host, path = host_and_path(url)
    parsed = pages.select(F.col(key).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return parsed.mapInArrow(tidy(judge), "page_id long, host string, path string, rule string, verdict string")


def op6_url_digest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


OP6_SQL = """
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rule_host, rule_path, rule_verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.rule_verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.page_id = b.page_id
"""
