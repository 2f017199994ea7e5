"""WARC archives with a Merkle fixity audit.

Pages become WARC/1.0 response records, one gzip member each, in segments of a
bounded size; a segment's index lists the offset range of every record.  A
replica is the table of its segments.  A leaf of the audit's trees is a record:
page id, start, end, stored bytes and whatever bytes follow up to the next
record, hashed together.  Runs of ``FAN``
neighbouring hashes are hashed up to the segment's root, segments to the root of
their part and parts to the root of the replica.  Two replicas are compared from
the root: only the branches whose hashes differ are descended, level by level,
down to the records.  So a shifted, reordered or forged index differs, and so do
bytes outside all records and records that one side lacks.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import zlib

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .common import maybe_broadcast, stage, table, tidy

FAN = 16
SEGMENT_BYTES = 4 << 20
#: Bytes that are decompressed at once.
PIECE = 1 << 14
#: Records carry no clock of their own: one capture date, so that equal input gives equal bytes.
CAPTURED = "2000-01-01T00:00:00Z"
#: In the query every page whose id is divisible by this has a byte of its record flipped in the second replica.
DAMAGED = 97

_ARCHIVE = "part int, segment int, index array<struct<page_id:long,start:long,end:long>>, data binary"
_INDEX = pa.list_(pa.struct([("page_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def record(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """One WARC/1.0 response record. The target has no line ends, so it can't forge headers."""
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    name = hashlib.sha256(f"{page_id}\0{target}\0".encode("utf-8", "surrogatepass") + payload).hexdigest()
    head = [
        "WARC/1.0", "WARC-Type: response", f"WARC-Record-ID: <urn:sha256:{name}>", f"WARC-Date: {CAPTURED}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}", "Content-Type: text/html", f"Content-Length: {len(payload)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload; ValueError if the length or the digest does not fit."""
    head, split, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not split or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(headers["Content-Length"])
    payload = rest[:n]
    if rest[n:] != b"\r\n\r\n" or headers["WARC-Payload-Digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}":
        raise ValueError("the record's payload is damaged")
    return headers, payload


def read_warc(data: bytes):
    """(offset, end, headers, payload) of each gzip member of a segment."""
    at, view = 0, memoryview(data)
    while at < len(data):
        d, raw, end = zlib.decompressobj(31), [], at
        # In pieces, so that a member costs its own bytes and not all that follow it.
        while not d.eof and end < len(data):
            piece = view[end : end + PIECE]
            raw.append(d.decompress(piece))
            end += len(piece) - len(d.unused_data)
        if not d.eof:
            raise ValueError("the segment ends within a record")
        yield (at, end, *parse_record(b"".join(raw)))
        at = end


def write_archive(pages: DataFrame, *, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Segments of the pages in ascending page_id order, staged. Null html is an empty payload, null url an empty target."""
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").repartitionByRange(n, "page_id").sortWithinPartitions("page_id", "url", "html")

    def write(batches):
        from pyspark import TaskContext

        part, segment, index, data = TaskContext.get().partitionId(), 0, [], bytearray()

        def close():
            nonlocal segment, index, data
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([index], _INDEX), pa.array([bytes(data)], pa.binary())], ["part", "segment", "index", "data"])
            segment, index, data = segment + 1, [], bytearray()
            return row

        for batch in batches:
            for page_id, url, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = gzip.compress(record(page_id, url, (page or "").encode("utf-8", "surrogatepass")), 6, mtime=0)
                index.append({"page_id": page_id, "start": len(data), "end": len(data) + len(raw)})
                data += raw
                if len(data) >= segment_bytes:
                    yield close()
        if index:
            yield close()

    return stage(ordered.mapInArrow(tidy(write), _ARCHIVE), "warc")


def damage(archive: DataFrame, divisor: int = DAMAGED) -> DataFrame:
    """A second replica, staged, in which pages with an id divisible by ``divisor`` have one byte flipped."""

    def flip(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data = bytearray(row["data"])
                for r in row["index"]:
                    if r["page_id"] is not None and r["page_id"] % divisor == 0:
                        data[(r["start"] + r["end"]) // 2] ^= 1
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([row["segment"]], pa.int32()), pa.array([row["index"]], _INDEX), pa.array([bytes(data)], pa.binary())], ["part", "segment", "index", "data"])

    return stage(archive.mapInArrow(tidy(flip), _ARCHIVE), "warc")


def levels(leaves: list[bytes]) -> list[list[bytes]]:
    """Hashes by level, leaves first, the root alone in the last. Leaves and inner nodes are hashed apart."""
    out = [[hashlib.sha256(b"\0" + x).digest() for x in leaves]]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([hashlib.sha256(b"\1" + b"".join(below[i : i + FAN])).digest() for i in range(0, len(below), FAN)])
    return out


def leaves(index: list, data: bytes) -> list[bytes]:
    """What is hashed of each record of a segment; bytes before the first record count with the last, all of them if there is none."""
    out, first = [], max(0, index[0]["start"]) if index else len(data)
    for k, r in enumerate(index):
        known, start, end = r["page_id"] is not None, max(0, r["start"]), max(0, r["end"])
        after = max(0, index[k + 1]["start"]) if k + 1 < len(index) else len(data)
        head = struct.pack("<?qqq", known, r["page_id"] if known else 0, r["start"], r["end"])
        out.append(head + data[start:end] + data[end:after] + (data[:first] if k + 1 == len(index) else b""))
    return out or [data]


def segment_nodes(replica: DataFrame) -> DataFrame:
    """part, segment, level, node, hash of every tree node inside a segment; ``top``: whether it is the segment's root."""

    def build(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tree = levels(leaves(row["index"], row["data"]))
                rows = [(k, i, h) for k, level in enumerate(tree) for i, h in enumerate(level)]
                lv, nd, hs = zip(*rows)
                n = len(rows)
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()), pa.array(lv, pa.int32()), pa.array(nd, pa.int32()), pa.array(hs, pa.binary()), pa.array([k == len(tree) - 1 for k in lv])], ["part", "segment", "level", "node", "hash", "top"])

    return replica.mapInArrow(tidy(build), "part int, segment int, level int, node int, hash binary, top boolean")


def _over(rows: DataFrame, group: str, order: str) -> DataFrame:
    """One hash for the ordered hashes of each group."""
    joined = F.concat(F.lit("\x01"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, F.hex("hash").alias("h")))), lambda x: x["h"]), ""))
    return rows.groupBy(group).agg(F.unhex(F.sha2(joined, 256)).alias("hash"))


def part_roots(nodes: DataFrame) -> DataFrame:
    return _over(nodes.filter("top"), "part", "segment")


def replica_root(parts: DataFrame) -> str | None:
    """The root over all parts, as hex; None for an empty replica. Parts are as many as the write had tasks."""
    row = _over(parts.withColumn("all", F.lit(0)), "all", "part").select(F.lower(F.hex("hash")).alias("h")).first()
    return row["h"] if row else None


def _differing(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose hashes differ, or that one side lacks."""
    both = a.select(*key, F.col("hash").alias("x")).join(b.select(*key, F.col("hash").alias("y")), key, "full")
    return both.filter(~F.col("x").eqNullSafe(F.col("y"))).select(*key)


def corrupt_records(a: DataFrame, b: DataFrame) -> DataFrame:
    """(part, segment, node) of the records that differ between two replicas' node tables, by descent."""
    spark = a.sparkSession
    nothing = spark.createDataFrame([], "part int, segment int, node int")
    parts_a, parts_b = part_roots(a), part_roots(b)
    if replica_root(parts_a) == replica_root(parts_b):
        return nothing
    parts = stage(_differing(parts_a, parts_b, ["part"]), "differing")
    inside = [x.join(parts, "part", "left_semi") for x in (a, b)]
    key = ["part", "segment", "level", "node"]
    open_nodes = stage(_differing(*[x.filter("top") for x in inside], key), "differing")
    found, depth = nothing, open_nodes.agg(F.max("level")).first()[0] or 0
    for level in range(depth, 0, -1):
        # Children of the differing nodes of this level; segments whose root is lower join in on their own level.
        wanted = open_nodes.filter(F.col("level") == level).select("part", "segment", F.col("node").alias("above"))
        below = [x.filter(F.col("level") == level - 1).withColumn("above", F.floor(F.col("node") / FAN).cast("int")).join(wanted, ["part", "segment", "above"], "left_semi") for x in inside]
        more = _differing(*below, key)
        open_nodes = stage(open_nodes.filter(F.col("level") < level).unionByName(more), "differing")
    return found.unionByName(open_nodes.filter("level = 0").select("part", "segment", "node"))


def contents(archive: DataFrame) -> DataFrame:
    """part, segment, node, page_id, start, length, payload_sha256 of every record, read from the stored bytes."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sums = [headers["WARC-Payload-Digest"].partition(":")[2] for _, _, headers, _ in read_warc(row["data"])]
                n, index = len(sums), row["index"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([r["page_id"] for r in index], pa.int64()), pa.array([r["start"] for r in index], pa.int64()), pa.array([r["end"] - r["start"] for r in index], pa.int64()), pa.array(sums)],
                    ["part", "segment", "node", "page_id", "start", "length", "payload_sha256"],
                )

    return archive.mapInArrow(tidy(read), "part int, segment int, node int, page_id long, start long, length long, payload_sha256 string")


def audit(archive: DataFrame, replica: DataFrame) -> DataFrame:
    """page_id, payload_sha256, intact of every record of ``archive``.

    intact: ``replica`` has the same page, offset range and bytes there, and the
    same bytes up to the next record.  Records that only the replica has give
    rows with their page_id, without payload_sha256, not intact.
    """
    a, b = (stage(segment_nodes(x), "nodes") for x in (archive, replica))
    bad = stage(corrupt_records(a, b), "corrupt").withColumn("intact", F.lit(False))
    records = contents(archive).join(maybe_broadcast(bad), ["part", "segment", "node"], "left")
    found = records.select("page_id", "payload_sha256", F.coalesce("intact", F.lit(True)).alias("intact"))
    own = archive.select("part", "segment", F.size("index").alias("n"))
    loose = bad.join(own, ["part", "segment"], "left").filter("node >= coalesce(n, 0)")
    names = replica.select("part", "segment", F.posexplode("index").alias("node", "r")).select("part", "segment", "node", F.col("r.page_id").alias("page_id"))
    more = loose.join(names, ["part", "segment", "node"]).select("page_id", F.lit(None).cast("string").alias("payload_sha256"), "intact")
    return found.unionByName(more)


def op8_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = write_archive(table(spark, sf_dir, "pages"))
    return audit(archive, damage(archive))


OP8_SQL = f"SELECT page_id, sha256(coalesce(html, '')) AS payload_sha256, coalesce(page_id % {DAMAGED} <> 0, true) AS intact FROM pages"
