"""Token ids of whole texts: pre-tokens found in numpy, each distinct one encoded once.

A byte-level BPE vocabulary never merges across the borders of its pre-tokens,
so the ids of a text are the concatenated ids of its pre-tokens.  Their borders
follow from the class of each character (letter, number, white space, other)
and of the one before, which numpy finds for many texts at once; Arrow reduces
the pre-tokens to distinct ones, a memo bounded in bytes gives the ids of those
met before and the library encodes the rest.  Texts with a character whose
class depends on the Unicode version, or with the text of an added token, go to
the library whole, and so does everything under any other kind of tokenizer.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import binary_buffers, ragged, run_hashes, string_buffers

#: Bytes after which a worker's memo keeps only what the last batch used.
MEMO_BYTES = 40 << 20
#: Bytes of text encoded at once; longer texts are cut where a pre-token surely starts.
BATCH_BYTES = 2 << 20
_LETTER, _NUMBER, _SPACE, _OTHER, _UNSURE = range(5)
_SAFE_CUT = re.compile(rb"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
#: Fixed by the vocabulary format: the printable bytes stand for themselves, the others for characters from 256 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SPELLED = np.arange(256, dtype="<u2")
_SPELLED[[b for b in range(256) if b not in _PRINTABLE]] = np.arange(256, 512 - len(_PRINTABLE))
_CONTRACTIONS = ((b"s", 2), (b"t", 2), (b"m", 2), (b"d", 2), (b"re", 3), (b"ve", 3), (b"ll", 3))
_ENCODERS: dict[str, "BatchEncoder"] = {}
_classes: np.ndarray | None = None


def _class_of(c: str) -> int:
    now, before = unicodedata.category(c), unicodedata.ucd_3_2_0.category(c)
    if now != before or now == "Cn":
        return _UNSURE
    if now[0] == "Z" or c in "\t\n\x0b\x0c\r\x85":
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(now[0], _OTHER)


def character_classes() -> np.ndarray:
    """The class of every code point; unsure where Unicode versions differ."""
    global _classes
    if _classes is None:
        _classes = np.full(0x110000, _UNSURE, np.uint8)
        # Code points beyond the second plane are rare enough to be left to the library.
        _classes[: 0x20000] = [_UNSURE if 0xD800 <= k < 0xE000 else _class_of(chr(k)) for k in range(0x20000)]
    return _classes


def _byte_classes(raw: np.ndarray) -> np.ndarray:
    """The class of the character that each byte is part of."""
    table = character_classes()
    out = table[raw]
    high = np.nonzero(raw >= 0xC0)[0]
    if not len(high):
        return out
    lead = raw[high].astype(np.int64)
    more = [raw[np.minimum(high + k, len(raw) - 1)].astype(np.int64) & 0x3F for k in (1, 2, 3)]
    two = (lead & 0x1F) << 6 | more[0]
    three = (lead & 0x0F) << 12 | more[0] << 6 | more[1]
    four = (lead & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2]
    kind = table[np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))]
    width = np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))
    for k in range(4):
        at = width > k
        out[high[at] + k] = kind[at]
    return out


def pre_tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pre-tokens start in the texts ``raw[offs[i]:offs[i + 1]]`` laid end to end, and which texts are unsure."""
    n = len(raw)
    kind = _byte_classes(raw)
    first = np.zeros(n + 1, bool)
    first[offs] = True
    unsure = np.unique(np.searchsorted(offs, np.nonzero(kind == _UNSURE)[0], "right") - 1)
    start = first[:n].copy()
    changed = kind[1:] != kind[:-1]
    start[1:] |= changed & (raw[:-1] != 32)
    # The last of several white spaces before a visible character stands apart: it opens the next pre-token or is one.
    space = kind == _SPACE
    last = np.nonzero(space[:-1] & ~space[1:] & ~first[1:n])[0]
    while len(last) and (inside := (raw[last] & 0xC0) == 0x80).any():
        last = np.where(inside, last - 1, last)
    start[last] = True
    # 's, 't, 're ... where an apostrophe opens a pre-token.
    marks = np.nonzero(start & (raw == 39))[0]
    marks = marks[marks + 1 < n]
    marks = marks[~first[marks + 1] & (kind[marks + 1] == _LETTER)]
    if len(marks):
        padded = np.concatenate([raw, np.zeros(3, np.uint8)])
        ends = np.concatenate([first, np.ones(3, bool)])
        for tail, width in _CONTRACTIONS:
            hit = marks
            for k, b in enumerate(tail, 1):
                hit = hit[(padded[hit + k] == b) & ~ends[hit + k]]
            start[hit + 1] = False
            start[hit[hit + width < n] + width] = True
    return np.nonzero(start)[0], unsure


class Places:
    """Places of 64-bit hashes in the order they were added: open addressing, a batch at once."""

    def __init__(self):
        self.hashes, self.table = np.zeros(0, np.uint64), np.full(1024, -1, np.int32)

    @property
    def nbytes(self) -> int:
        return self.hashes.nbytes + self.table.nbytes

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        found, left, slots = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), self._slots(hashes)
        while len(left):
            place = self.table[slots]
            taken = place >= 0
            left, slots, place = left[taken], slots[taken], place[taken]
            hit = self.hashes[place] == hashes[left]
            found[left[hit]] = place[hit]
            left, slots = left[~hit], slots[~hit] + 1 & len(self.table) - 1
        return found

    def add(self, hashes: np.ndarray) -> None:
        new = np.arange(len(self.hashes), len(self.hashes) + len(hashes), dtype=np.int32)
        self.hashes = np.concatenate([self.hashes, hashes])
        if 2 * len(self.hashes) > len(self.table):
            self.table = np.full(1 << (2 * len(self.hashes)).bit_length(), -1, np.int32)
            new = np.arange(len(self.hashes), dtype=np.int32)
        slots = self._slots(self.hashes[new])
        while len(new):
            free = self.table[slots] < 0
            self.table[slots[free]] = new[free]
            late = self.table[slots] != new
            new, slots = new[late], slots[late] + 1 & len(self.table) - 1


class BatchEncoder:
    """Encodes string columns to little-endian unsigned ids of ``dtype``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4")
        pre = str(self.tokenizer.pre_tokenizer)
        normal = self.tokenizer.normalizer is None and self.tokenizer.post_processor is None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_part = normal and "ByteLevel(add_prefix_space=False" in pre and "use_regex=True" in pre
        self._forget()

    def _forget(self) -> None:
        self.known, self.places = pa.array([], pa.large_binary()), Places()
        self.known_ids, self.known_cuts = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def _raw(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens laid end to end, and how many each has, straight from the vocabulary's merges: all that comes before them is done."""
        merge, spelled, ids, sizes = self.tokenizer.model.tokenize, _SPELLED[raw].tobytes().decode("utf-16-le"), [], []
        cuts = offs.tolist()
        for a, b in zip(cuts, cuts[1:]):
            found = merge(spelled[a:b])
            sizes.append(len(found))
            ids += [t.id for t in found]
        return np.array(ids, self.dtype), np.array(sizes, np.int64)

    def _distinct(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids and cuts of distinct pre-tokens, from the memo or the library; the memo learns them."""
        raw, offs = binary_buffers(parts)
        hashes = run_hashes(raw, offs)
        place = self.places.find(hashes)
        met = np.nonzero(place >= 0)[0]
        if len(met):  # what only shares a hash with a known one is new
            same = pc.equal(self.known.take(pa.array(place[met])), parts.take(pa.array(met))).to_numpy(zero_copy_only=False)
            place[met[~same]] = -1
        new = np.nonzero(place < 0)[0]
        if len(new):
            fresh = parts.take(pa.array(new))
            learned, sizes = self._learn(*binary_buffers(fresh))
            place[new] = len(self.known) + np.arange(len(new))
            self.places.add(hashes[new])
            self.known = pa.concat_arrays([self.known, fresh])
            self.known_ids = np.concatenate([self.known_ids, learned])
            self.known_cuts = np.concatenate([self.known_cuts, self.known_cuts[-1] + np.cumsum(sizes)])
        sizes = self.known_cuts[place + 1] - self.known_cuts[place]
        ids = self.known_ids[ragged(self.known_cuts[place], sizes)]
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        if self.known.nbytes + self.places.nbytes + self.known_ids.nbytes + self.known_cuts.nbytes > MEMO_BYTES:
            self.known, self.known_ids, self.known_cuts, self.places = parts, ids, cuts, Places()
            self.places.add(hashes)
        return ids, cuts

    def _stretch(self, raw: np.ndarray, offs: np.ndarray, whole: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """ids of the texts of a stretch, end to end, and where each text's begin; those marked ``whole`` go to the library."""
        starts, unsure = pre_tokens(raw, offs)
        if whole is not None and whole.any():
            unsure = np.union1d(unsure, np.nonzero(whole)[0])
        bounds = np.concatenate([starts, [len(raw)]]).astype(np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(raw)]).dictionary_encode()
        ids, cuts = self._distinct(parts.dictionary.cast(pa.large_binary()))
        index = parts.indices.to_numpy()
        sizes = (cuts[1:] - cuts[:-1])[index]
        out = ids[ragged(cuts[:-1][index], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offs)]
        if not len(unsure):
            return out, ends
        texts = [raw[offs[i] : offs[i + 1]].tobytes().decode() for i in unsure]
        read = dict(zip(unsure.tolist(), self._raw(texts)))
        found = [read.get(i, out[ends[i] : ends[i + 1]]) for i in range(len(offs) - 1)]
        return np.concatenate(found), np.concatenate([[0], np.cumsum([len(x) for x in found])])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all rows end to end, and the cuts between rows; null rows have none."""
        raw, offs = string_buffers(column)
        whole = np.full(len(column), not self.by_part)
        for token in self.added:
            whole |= pc.match_substring(column, token).fill_null(False).to_numpy(zero_copy_only=False)
        found, cuts, lo = [np.zeros(0, self.dtype)], [np.zeros(1, np.int64)], 0
        while lo < len(offs) - 1:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + BATCH_BYTES, "right")) - 1)
            part, at = raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            if not len(part):
                ids, ends = found[0], np.zeros(len(at), np.int64)
            elif len(part) > BATCH_BYTES and not whole[lo]:
                ids, ends = self._long(part)
            else:
                ids, ends = self._stretch(part, at, whole[lo:hi])
            found.append(ids)
            cuts.append(cuts[-1][-1] + ends[1:])
            lo = hi
        return np.concatenate(found), np.concatenate(cuts)

    def _long(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One text that is longer than a stretch: in stretches, if all its characters are sure."""
        data, bounds = raw.tobytes(), [0]
        if (_byte_classes(raw) == _UNSURE).any():
            ids = self._raw([data.decode()])[0]
            return ids, np.array([0, len(ids)])
        while len(data) - bounds[-1] > BATCH_BYTES:
            m = _SAFE_CUT.search(data, bounds[-1] + BATCH_BYTES // 2)
            if not m:
                break
            bounds.append(m.start())
        bounds.append(len(data))
        ids = np.concatenate([self._stretch(raw[a:b], np.array([0, b - a]))[0] for a, b in zip(bounds, bounds[1:])])
        return ids, np.array([0, len(ids)])

    def arrays(self, texts: list[str]) -> list[np.ndarray]:
        ids, cuts = self.encode(pa.array(texts, pa.large_string()))
        return [ids[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def encoder(path: str) -> BatchEncoder:
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]


def stretches(batches, column: int):
    """Slices of ``batches`` with some ``BATCH_BYTES`` of text in ``column`` each, one row at least."""
    for batch in batches:
        _, offs = string_buffers(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + BATCH_BYTES, "right")) - 1)
            hi = min(hi, lo + 20_000)
            yield batch.slice(lo, hi - lo)
            lo = hi


def forget() -> bool:
    """Whether there was anything to forget."""
    held = bool(_ENCODERS)
    _ENCODERS.clear()
    return held


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def crc_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
