"""Token-ID output: an adaptive context-mixing range coder over segments of id blocks.

A *segment* holds whole documents, in order, as one self-contained byte string:
header, id frequencies (the order-0 prediction), document index, blocks of
``BLOCK`` ids and the header again.  Every block starts from a reset model and
carries the crc32 of its ids, so a damaged block is found and costs no other,
and a damaged header costs none.

Inside a block the next id is predicted three ways: by the segment's id
frequencies (order 0), by the id that last followed the previous id (order 1)
and by the id that last followed the previous two (order 2).  The three are
mixed with weights that adapt, in each block, to how often each was right under
the current confidences, and the mixture drives one arithmetic-coding step per
id.  The frequencies themselves are the segment's and do not change within a
block: cumulative counts of a whole vocabulary can't be kept per lane.  All
blocks of a segment advance together, one id a step, as numpy lanes: the state
of the coder is a handful of arrays whose size is the number of blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import maybe_broadcast, stage, tidy
from .tokens import crc_ids, default_vocabulary, encoder, stretches

MAGIC = b"TCM1"
BLOCK = 2048
#: Ids after which a segment is closed at the next document end.
SEGMENT_IDS = 4_000_000
_T0 = 18  # log2 of the order-0 total
_W = 8  # log2 of the sum of the weights
_TOTAL = _T0 + _W
_BITS1, _BITS2 = 9, 11  # log2 of the slots of the order-1 and order-2 tables of a block
#: The coder's state has 48 bits, so that quotients in float64 are exact; 16 of them are written at a time.
_LOW = np.int64(1) << np.int64(32)
_MOST = (1 << _W) - 8  # what orders 1 and 2 may weigh together
_RATE = 4
_HASH1, _HASH2 = np.uint32(2654435761), np.uint32(2246822519)


class CorruptBlock(ValueError):
    """A block whose ids do not match their checksum; ``blocks`` lists the numbers."""

    def __init__(self, blocks):
        super().__init__(f"blocks with wrong checksums: {list(blocks)[:20]}")
        self.blocks = list(blocks)


def _quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies with sum 2**_T0, at least 1 for every id that occurs."""
    total = 1 << _T0
    freq = np.where(counts > 0, np.maximum(1, counts * total // max(1, counts.sum())), 0).astype(np.int64)
    over = int(freq.sum()) - total
    if over <= 0:
        freq[int(freq.argmax())] -= over
        return freq
    for i in np.argsort(-freq):
        take = min(over, int(freq[i]) - 1)
        freq[i] -= take
        over -= take
        if not over:
            return freq
    raise ValueError("more distinct ids than the order-0 total")


_PARTS = 1 / np.maximum(np.arange((1 << _W) + 1), 1)


def _less(a, b):
    return (a - b) >> 31


def _equal(a, b):
    """For numbers from 0 on."""
    return ((a ^ b) - 1) >> 31


def _chosen(a, b, mask):
    return b ^ ((a ^ b) & mask)


class _Model:
    """Predictions and weights of all lanes; both directions call the same methods."""

    def __init__(self, lanes: int, freq: np.ndarray):
        self.freq, self.cum = freq.astype(np.int32), np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.int32)
        self.at1, self.at2, self.atw = (np.arange(lanes, dtype=np.int64) << b for b in (_BITS1, _BITS2, 5))
        # An entry is an id and, in two bits, how often it was right on end.
        self.last1 = np.zeros(lanes << _BITS1, np.int32)
        self.last2 = np.zeros(lanes << _BITS2, np.int32)
        # Weights of order 1 (low half) and order 2 by both confidences and agreement; order 0 has the rest.
        c2, c1, same = np.indices((4, 4, 2), dtype=np.int32)
        self.weights = np.tile(((16 + 32 * c2) << 16 | (8 + 18 * c1) * (1 - same)).ravel().astype(np.int32), lanes)
        self.mark = np.zeros(lanes, np.uint32)
        self.before = np.zeros(lanes, np.uint32)

    # Comparisons are made as 32-bit masks, all ones or all zeros, which numpy combines without converting.

    def predict(self) -> None:
        self.i1 = self.at1 + (self.mark >> np.uint32(32 - _BITS1))
        self.i2 = self.at2 + ((self.mark ^ self.before * _HASH2) >> np.uint32(32 - _BITS2))
        self.t1, self.t2 = self.last1.take(self.i1), self.last2.take(self.i2)
        self.p1, self.p2 = self.t1 >> 2, self.t2 >> 2
        self.same = _equal(self.p1, self.p2)
        self.iw = self.atw + ((self.t2 & 3) << 3 | (self.t1 & 3) << 1 | self.same & 1)
        w = self.weights.take(self.iw)
        self.w1, self.w2 = w & 0xFFFF, w >> 16
        self.w0 = (1 << _W) - self.w1 - self.w2
        self.b1, self.b2 = self.w1 << _T0, self.w2 << _T0

    def interval(self, ids):
        """Start and width of ``ids`` in the mixture, out of 2**_TOTAL."""
        self.hit1, self.hit2 = _equal(ids, self.p1), _equal(ids, self.p2)
        low = self.w0 * self.cum.take(ids) + (self.b1 & _less(self.p1, ids)) + (self.b2 & _less(self.p2, ids))
        return low.astype(np.int64), (self.w0 * self.freq.take(ids) + (self.b1 & self.hit1) + (self.b2 & self.hit2)).astype(np.int64)

    def find(self, at, inverse):
        """The ids whose intervals hold ``at``."""
        s2 = self.w0 * self.cum.take(self.p2) + (self.b1 & _less(self.p1, self.p2))
        e2 = s2 + self.w0 * self.freq.take(self.p2) + self.b2 + (self.b1 & self.same)
        s1 = self.w0 * self.cum.take(self.p1) + (self.b2 & _less(self.p2, self.p1))
        e1 = s1 + self.w0 * self.freq.take(self.p1) + self.b1 + (self.b2 & self.same)
        before1, before2 = _less(at, e1), _less(at, e2)
        rest = at - (self.b2 & ~before2) - (self.b1 & ~before1)
        # The half keeps products with a rounded reciprocal on the right side of whole numbers.
        ids = inverse.take(((rest + 0.5) * _PARTS.take(self.w0)).astype(np.int32), mode="clip")
        ids = _chosen(self.p2, ids, before2 & ~_less(at, s2))
        return _chosen(self.p1, ids, before1 & ~_less(at, s1))

    def update(self, ids) -> None:
        """Weights move towards the highest order that was right; a wrong entry is replaced."""
        self.w1 += ((self.hit1 & ~self.hit2 & _MOST) - self.w1) >> _RATE
        self.w2 += ((self.hit2 & _MOST) - self.w2) >> _RATE
        self.weights[self.iw] = self.w2 << 16 | self.w1
        new = ids << 2
        self.last1[self.i1] = _chosen(self.t1 - _less(self.t1 & 3, 3), new, self.hit1)
        self.last2[self.i2] = _chosen(self.t2 - _less(self.t2 & 3, 3), new, self.hit2)
        self.before, self.mark = self.mark, ids.view(np.uint32) * _HASH1


def _with_carries(words: np.ndarray) -> np.ndarray:
    """16-bit words from sums that may overflow into the word before."""
    carry = words >> 16
    out = words & 0xFFFF
    while carry.any():
        moved = np.zeros_like(out)
        moved[:-1] = carry[1:]
        out += moved
        carry, out = out >> 16, out & 0xFFFF
    return out.astype("<u2")


def encode_blocks(blocks: np.ndarray, freq: np.ndarray) -> list[np.ndarray]:
    """``blocks``: lanes x steps of ids. The 16-bit words of each lane."""
    lanes, steps = blocks.shape
    model = _Model(lanes, freq)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, _LOW << np.int64(16), np.int64)
    row = 2 * steps + 8
    out = np.zeros(lanes * row, np.int32)
    at = np.arange(lanes, dtype=np.int64) * row
    by_step = np.ascontiguousarray(blocks.T.astype(np.int32))
    for k in range(steps):
        ids = by_step[k]
        model.predict()
        start, width = model.interval(ids)
        unit = span >> _TOTAL
        low += unit * start
        span = unit * width
        model.update(ids)
        short = np.nonzero(span < _LOW)[0]
        while short.size:
            x, y = low.take(short), span.take(short) << 16
            to = at.take(short)
            out[to] = x >> 32
            at[short] = to + 1
            low[short] = (x & (_LOW - 1)) << 16
            span[short] = y
            short = short[y < _LOW]
    for _ in range(3):
        out[at] = low >> 32
        at += 1
        low = (low & (_LOW - 1)) << 16
    return [_with_carries(out[i * row : at[i]]) for i in range(lanes)]


@np.errstate(all="ignore")  # damaged blocks may run into zero widths
def decode_blocks(words: list[np.ndarray], steps: int, freq: np.ndarray) -> np.ndarray:
    lanes = len(words)
    model = _Model(lanes, freq)
    inverse = np.repeat(np.arange(len(freq), dtype=np.int32), freq)
    # Lanes end to end; a damaged one may read on into its neighbour or the zeros at the end.
    flat = np.concatenate([*words, np.zeros(8, "<u2")]).astype(np.int64)
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])])[:-1].astype(np.int64)
    code = np.zeros(lanes, np.int64)
    for _ in range(3):
        code = code << 16 | flat.take(at, mode="clip")
        at += 1
    span = np.full(lanes, _LOW << np.int64(16), np.int64)
    out = np.zeros((steps, lanes), np.int32)
    for k in range(steps):
        model.predict()
        unit = span >> _TOTAL
        ids = model.find(np.minimum(code / unit, (1 << _TOTAL) - 1).astype(np.int32), inverse)
        start, width = model.interval(ids)
        code -= unit * start
        span = unit * width
        model.update(ids)
        out[k] = ids
        short = np.nonzero(span < _LOW)[0]
        while short.size:
            y, of = span.take(short) << 16, at.take(short)
            code[short] = code.take(short) << 16 | flat.take(of, mode="clip")
            at[short] = of + 1
            span[short] = y
            short = short[(y < _LOW) & (y > 0)]
    return out.T


def pack_segment(doc_ids: list, docs: list[np.ndarray], block: int = BLOCK) -> bytes:
    """The bytes of one segment: documents (id or None) with their ids, whole and in order."""
    lengths = np.array([len(d) for d in docs], dtype="<u4")
    ids = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    keys = np.array([d if d is not None else 0 for d in doc_ids], dtype="<i8")
    n_blocks = -(-len(ids) // block)
    steps = min(block, len(ids))
    counts = np.bincount(ids) if len(ids) else np.zeros(1, np.int64)
    freq = _quantise(np.maximum(counts, 0)) if len(ids) else counts
    if n_blocks:
        padded = np.full(n_blocks * steps, ids[0] if n_blocks == 1 else int(counts.argmax()), np.int64)
        padded[: len(ids)] = ids
        lanes = padded.reshape(n_blocks, steps)
        words = encode_blocks(lanes, freq)
        sums = np.array([crc_ids(ids[i * steps : (i + 1) * steps]) for i in range(n_blocks)], dtype="<u4")
    else:
        words, sums = [], np.zeros(0, "<u4")
    present = np.nonzero(freq)[0].astype("<u4")
    parts = [zlib.compress(x.tobytes(), 6) for x in (present, freq[present].astype("<u4"), known, keys, lengths, np.array([len(w) for w in words], "<u4"), sums)]
    head = struct.pack("<QIIII", len(ids), steps, n_blocks, len(docs), len(freq)) + struct.pack("<7I", *map(len, parts)) + b"".join(parts)
    frame = struct.pack("<II", len(head), zlib.crc32(head))
    return MAGIC + frame + head + b"".join(w.tobytes() for w in words) + head + frame


def _header(blob: bytes) -> bytes:
    """The header, or its copy at the end if it is damaged: what all blocks need is stored twice."""
    size, crc = struct.unpack_from("<II", blob, 4)
    head = blob[12 : 12 + size]
    if zlib.crc32(head) == crc and blob[:4] == MAGIC:
        return head
    size, crc = struct.unpack_from("<II", blob, len(blob) - 8)
    head = blob[max(0, len(blob) - 8 - size) : -8]
    if zlib.crc32(head) != crc or len(head) != size:
        raise ValueError("not a token segment, or both its headers are damaged")
    return head


def unpack_segment(blob: bytes, *, check: bool = True) -> tuple[list, list[np.ndarray]]:
    """Document ids and their id arrays. Raises CorruptBlock if a checksum differs."""
    head = _header(blob)
    size = len(head)
    n, steps, n_blocks, n_docs, vocab = struct.unpack_from("<QIIII", head)
    sizes = struct.unpack_from("<7I", head, 24)
    at, parts = 52, []
    for s in sizes:
        parts.append(zlib.decompress(head[at : at + s]))
        at += s
    present, f = np.frombuffer(parts[0], "<u4"), np.frombuffer(parts[1], "<u4")
    known, keys = np.frombuffer(parts[2], np.uint8), np.frombuffer(parts[3], "<i8")
    lengths, n_words, sums = (np.frombuffer(p, "<u4") for p in parts[4:])
    freq = np.zeros(vocab, np.int64)
    freq[present] = f
    cuts = np.concatenate([[0], np.cumsum(n_words, dtype=np.int64)])
    flat = np.frombuffer(blob, "<u2", int(cuts[-1]), 12 + size)
    if n_blocks:
        ids = decode_blocks([flat[cuts[i] : cuts[i + 1]] for i in range(n_blocks)], steps, freq).ravel()[:n]
        bad = [i for i in range(n_blocks) if crc_ids(ids[i * steps : (i + 1) * steps]) != sums[i]]
        if check and bad:
            raise CorruptBlock(bad)
    else:
        ids = np.zeros(0, np.int64)
    ends = np.cumsum(lengths, dtype=np.int64)
    return [int(k) if ok else None for k, ok in zip(keys, known)], [ids[e - c : e] for e, c in zip(ends, lengths.astype(np.int64))]


_SEGMENTS = "part int, seq int, in_part long, n_ids long, blob binary"


def write_tokens(docs: DataFrame, *, vocabulary: str | None = None, end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Segments of ``docs`` (doc_id, text) in ascending doc_id order, staged in the shared folder.

    Null text is an empty text; a null doc_id sorts first; rows of one doc_id
    stay apart, in the order of their texts; other columns are ignored.
    """
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        from pyspark import TaskContext

        enc, part, seq, in_part = encoder(vocabulary), TaskContext.get().partitionId(), 0, 0
        keys, held, size = [], [], 0

        def close():
            nonlocal keys, held, size, seq, in_part
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([in_part], pa.int64()), pa.array([size], pa.int64()), pa.array([pack_segment(keys, held)], pa.binary())], ["part", "seq", "in_part", "n_ids", "blob"])
            seq, in_part = seq + 1, in_part + size
            keys, held, size = [], [], 0
            return row

        for some in stretches(batches, 1):
            ids, cuts = enc.encode(some.column(1))
            ids, cuts = np.insert(ids, cuts[1:], enc.dtype.type(end_id)), cuts + np.arange(len(cuts))
            for key, a, b in zip(some.column(0).to_pylist(), cuts.tolist(), cuts[1:].tolist()):
                keys.append(key)
                held.append(ids[a:b])
                size += b - a
                if size >= segment_ids:
                    yield close()
        if keys:
            yield close()

    return stage(ordered.mapInArrow(tidy(write, tokens=True), _SEGMENTS), "tokens")


_DOCS = "doc_id long, part int, in_part long, n_tokens long, ids_crc32 long"


def read_tokens(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the segments."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, docs = unpack_segment(row["blob"])
                sizes = np.array([len(d) for d in docs], np.int64)
                starts = row["in_part"] + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([row["part"]] * len(keys), pa.int32()), pa.array(starts), pa.array(sizes), pa.array([crc_ids(d) for d in docs], pa.int64())], ["doc_id", "part", "in_part", "n_tokens", "ids_crc32"])

    spark = segments.sparkSession
    # One total a write partition reaches the driver, however large the corpus.
    totals = sorted((r["part"], r["n"]) for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, rows = 0, []
    for part, n in totals:
        rows.append((part, before))
        before += n
    starts = spark.createDataFrame(rows, StructType([StructField("part", IntegerType()), StructField("before", LongType())]))
    found = segments.select("part", "in_part", "blob").mapInArrow(tidy(read), _DOCS)
    return found.join(maybe_broadcast(starts), "part").select("doc_id", (F.col("before") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), end_id=0))
