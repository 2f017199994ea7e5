"""Best-fit packing by hierarchical residual merging.

Documents become pieces of at most ``capacity`` ids.  Full pieces are sequences
already.  The rest are dealt into groups of a bounded number of pieces; each
group packs its pieces best-fit decreasing and emits the nearly full bins.  The
emptiest bins go up a tree as items: ``FAN_IN`` groups meet, their bins are
best-fitted into one another, and so on to the root.  What a group sends up is
bounded, so no task ever holds more than ``FAN_IN * CARRY`` bins above the
leaves; bins beyond that are emitted as they are, so every piece is placed.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .common import stage, table, tidy
from .tokens import default_vocabulary, encoder, stretches

CAPACITY = 1024
GROUP_PIECES = 4096
FAN_IN = 4
CARRY = 64
#: A bin with less room than this is emitted at once.
NEARLY_FULL = 8

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_BINS = "slot long, bin long, fill int, members array<struct<row:long,offset:int>>, done boolean"


def cut_pieces(docs: DataFrame, *, vocabulary: str | None = None, end_id: int = 2, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """One row per piece. Null text is empty, so its only id is the end id."""
    vocabulary = vocabulary or default_vocabulary()

    def cut(batches):
        for some in stretches(batches, 1):
            enc = encoder(vocabulary)
            ids, cuts = enc.encode(some.column(1))
            raw = memoryview(np.insert(ids, cuts[1:], enc.dtype.type(end_id)).astype("<u4").tobytes())
            out = ([], [], [], [], [])
            begin = 0
            for key, end in zip(some.column(0).to_pylist(), (cuts[1:] + np.arange(1, len(cuts))).tolist()):
                at, upto, piece = begin, begin + ((end - begin) % capacity or capacity), 0
                while at < end:
                    for col, v in zip(out, (key, piece, at - begin, upto - at, zlib.crc32(raw[4 * at : 4 * upto]))):
                        col.append(v)
                    at, upto, piece = upto, upto + capacity, piece + 1
                begin = end
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(tidy(cut, tokens=True), _PIECES)


def best_fit(lengths, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the indices of each bin's items.

    Bins wait in a stack per amount of room; the set of rooms in use is one
    integer, so the tightest room that fits is the lowest bit of a shift.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in order:
        size = lengths[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        room -= size
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins


def _pack(slot: int, fills: list[int], members: list[list], capacity: int) -> pd.DataFrame:
    bins = []
    for inside in best_fit(fills, capacity):
        placed, at = [], 0
        for i in inside:
            placed += [{"row": m["row"], "offset": m["offset"] + at} for m in members[i]]
            at += fills[i]
        bins.append((at, placed))
    bins.sort(key=lambda b: b[0])
    rows = [(slot // FAN_IN, slot << 24 | k, fill, inside, k >= CARRY or fill > capacity - NEARLY_FULL) for k, (fill, inside) in enumerate(bins)]
    return pd.DataFrame(rows, columns=["slot", "bin", "fill", "members", "done"])


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """row, sequence_id, offset of every piece below ``capacity``; ``pieces`` (row, length) must be staged, it is read twice."""
    small = pieces.filter(F.col("length") < capacity)
    n = small.count()
    groups = max(1, -(-n // group_pieces))
    items = small.select("row", F.col("length").cast("int").alias("length"), F.pmod(F.xxhash64("row"), F.lit(groups)).alias("slot"))

    def leaves(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        members = [[{"row": r, "offset": 0}] for r in pdf["row"].tolist()]
        return _pack(int(key[0]), pdf["length"].tolist(), members, capacity)

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        return _pack(int(key[0]), pdf["fill"].tolist(), [list(m) for m in pdf["members"]], capacity)

    level = stage(items.groupBy("slot").applyInPandas(leaves, _BINS), "bins")
    found, depth = [level.filter("done").withColumn("level", F.lit(0))], 0
    while groups > 1:
        groups, depth = -(-groups // FAN_IN), depth + 1
        level = stage(level.filter("not done").groupBy("slot").applyInPandas(merge, _BINS), "bins")
        found.append(level.filter("done").withColumn("level", F.lit(depth)))
    found.append(level.filter("not done").withColumn("level", F.lit(depth)))
    bins = found[0]
    for more in found[1:]:
        bins = bins.unionByName(more)
    # A sequence's number: tree level, then group and bin within the level.
    members = bins.select((F.shiftleft(F.col("level").cast("long"), 56) + F.col("bin")).alias("sequence_id"), F.explode("members").alias("m"))
    return members.select("m.row", "sequence_id", F.col("m.offset").cast("long").alias("offset"))


def pack_documents(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = 2, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents with their place. Repeated doc_ids are separate documents."""
    cut = cut_pieces(docs, vocabulary=vocabulary, end_id=end_id, capacity=capacity)
    pieces = stage(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    placed = pack_pieces(pieces, capacity=capacity)
    # Full pieces are a sequence each: negative numbers, so that none meets a packed one.
    full = pieces.filter(F.col("length") >= capacity).withColumn("sequence_id", -F.col("row") - 1).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.filter(F.col("length") < capacity).join(placed, "row")
    return full.unionByName(rest).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
