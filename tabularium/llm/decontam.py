"""Benchmark decontamination: a BM25 inverted index of test items, queried by every training passage.

The index holds the items' terms with impacts (BM25 weights as shares of the
item's own score), in postings by item with a maximum per block.  A passage is
a run of words long enough that any copy of an item lies whole in one.  It
retrieves every item it scores ``THRESHOLD`` or more of, by block-max WAND;
passages that lack the rarest terms of every item are passed over beforehand,
from sums over the whole text: an item's other terms alone cannot reach the
threshold.  A retrieved item counts as leaked if the passage also holds enough
of the word shingles of its question and of its answer, or of the whole item if
nothing marks an answer (there its last sentence is tried as one too).

Items are a stated list.  They are taken in slices of at most ``SLICE`` items and
``SLICE_BYTES`` of text, each a bounded index that goes to every task, and
``AT_ONCE`` slices are probed in one pass over the passages, so any number of
items works.  A single item that is longer is a slice by itself.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .common import table, tidy
from .words import mix, split_words, string_buffers

THRESHOLD = 0.8
#: Shingles of five words; share of them that question and answer must each show.
SHINGLE = 5
OVERLAP = 0.8
K1, B = 1.2, 0.75
#: Items per block of a postings list, and per index.
BLOCK = 16
SLICE = 20_000
SLICE_BYTES = 4 << 20
#: Indexes that a pass holds.
AT_ONCE = 4
#: Longer items are looked up by runs of this many words.
PROBE_WORDS = 64
#: Score that an item's rarest, essential terms must bring: the others cannot make up for it.
NEEDED = 0.4

_MARK = re.compile(r"\b(?:answer|a)\s*:", re.I)
_SEPARATOR = np.arange(256, dtype=np.uint8)
_SEPARATOR[[b for b in range(128) if not chr(b).isalnum()]] = 32


def normal_words(texts: list[str]):
    """Words of case-folded texts; ASCII punctuation parts words like white space."""
    raw, offs = string_buffers(pa.array([t.casefold() for t in texts], pa.large_string()))
    column = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offs.astype(np.int64).tobytes()), pa.py_buffer(_SEPARATOR[raw].tobytes())])
    return split_words(column)


def marked_answer(text: str) -> tuple[str, str] | None:
    """Parted at an "answer:" mark, else after the last question mark."""
    m = None
    for m in _MARK.finditer(text):
        pass
    if m and text[: m.start()].strip() and text[m.end() :].strip():
        return text[: m.start()], text[m.end() :]
    return _parted(text, "?")


def question_and_answer(text: str) -> tuple[str, str]:
    """As marked, else parted before the last line or sentence."""
    return marked_answer(text) or _parted(text, "\n") or _parted(text, ". ") or (text, text)


def _parted(text: str, mark: str) -> tuple[str, str] | None:
    at = text.rstrip(" .\n").rfind(mark)
    return (text[: at + 1], text[at + 1 :]) if at >= 0 and text[at + 1 :].strip(" .\n") else None


class Index:
    """Of one slice of (item_id, text); plain arrays and dicts, so it pickles small."""

    def __init__(self, items: list[tuple[int, str]]):
        self.parts, self.whole, probes = [], [], []
        for at, (_, text) in enumerate(items):
            self.parts.append([self._shingles(normal_words([p]).hashes) for p in question_and_answer(text)])
            words = normal_words([text]).hashes
            self.whole.append(None if marked_answer(text) else [self._shingles(words)] * 2)
            for lo in range(0, max(1, len(words)), PROBE_WORDS):
                probe = words[lo : lo + PROBE_WORDS]
                if len(probe) >= SHINGLE or not lo and len(probe):
                    probes.append((at, probe))
        self.items = [i for i, _ in items]
        self.item_of = [p[0] for p in probes]
        self.longest = max((len(w) for _, w in probes), default=1)
        counts = [dict(zip(*(x.tolist() for x in np.unique(w, return_counts=True)))) for _, w in probes]
        n, mean = max(1, len(probes)), np.mean([len(w) for _, w in probes] or [1])
        held: dict[int, int] = {}
        for c in counts:
            for t in c:
                held[t] = held.get(t, 0) + 1
        idf = {t: float(np.log1p((n - d + 0.5) / (d + 0.5))) for t, d in held.items()}
        self.terms = np.array(sorted(held), np.uint64)
        place = {t: k for k, t in enumerate(self.terms.tolist())}
        self.postings: list[list[tuple[int, float]]] = [[] for _ in place]
        essential: list[list[tuple[int, float]]] = [[] for _ in place]
        for p, ((_, words), c) in enumerate(zip(probes, counts)):
            weight = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(words) / mean)) for t, f in c.items()}
            own, brought = sum(weight.values()), 0.0
            for t in sorted(weight, key=lambda t: (held[t], t)):
                share = weight[t] / own
                self.postings[place[t]].append((p, share))
                # The essential terms' share is such that what is left stays NEEDED below the threshold.
                if brought < 1 - THRESHOLD + NEEDED:
                    essential[place[t]].append((p, share))
                    brought += share
        self.most = np.array([max(x for _, x in p) for p in self.postings] or [0.0])
        sizes = np.array([len(p) for p in essential] or [0])
        self.essential_cuts = np.concatenate([[0], np.cumsum(sizes)])
        self.essential = np.array([p for x in essential for p, _ in x], np.int64), np.array([w for x in essential for _, w in x])
        self.blocks = [[max(x for _, x in p[lo : lo + BLOCK]) for lo in range(0, len(p), BLOCK)] for p in self.postings]

    @staticmethod
    def _shingles(hashes: np.ndarray) -> np.ndarray:
        size = min(SHINGLE, len(hashes))
        if not size:
            return hashes
        with np.errstate(over="ignore"):
            out = np.zeros(len(hashes) - size + 1, np.uint64)
            for k in range(size):
                out = mix(out * np.uint64(31) + hashes[k : len(hashes) - size + 1 + k])
        return np.unique(out)

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """(probe, score) of all probes that the terms (distinct places) score THRESHOLD or more of."""
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]
        found, least = [], THRESHOLD - 1e-9
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                break
            probe = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == probe:
                pivot += 1
            # The blocks in which each list up to the pivot would hold the probe.
            bound, end = 0.0, None
            for c in cursors[: pivot + 1]:
                postings = self.postings[c[2]]
                at = bisect_left(postings, (probe, -1.0), c[1])
                if at < len(postings):
                    block = at // BLOCK
                    bound += self.blocks[c[2]][block]
                    last = postings[min(len(postings), (block + 1) * BLOCK) - 1][0]
                    end = last if end is None else min(end, last)
            if bound >= least:
                score = 0.0
                for c in cursors[: pivot + 1]:
                    at = bisect_left(self.postings[c[2]], (probe, -1.0), c[1])
                    if at < len(self.postings[c[2]]) and self.postings[c[2]][at][0] == probe:
                        score += self.postings[c[2]][at][1]
                if score >= least:
                    found.append((probe, score))
                goal = probe + 1
            else:
                # No probe up to the nearest block end, or the next list's probe, can reach the threshold.
                goal = (probe if end is None else max(probe, end)) + 1
                if pivot + 1 < len(cursors):
                    goal = max(probe + 1, min(goal, cursors[pivot + 1][0]))
            for c in cursors[: pivot + 1]:
                postings = self.postings[c[2]]
                c[1] = bisect_left(postings, (goal, -1.0), c[1])
                c[0] = postings[c[1]][0] if c[1] < len(postings) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def search(self, texts: list[str]) -> list[dict[int, tuple[float, float, float]]]:
        """For each text: item number to (score, question overlap, answer overlap) of the leaked items."""
        out: list[dict] = [{} for _ in texts]
        if not len(self.terms):
            return out
        w = normal_words(texts)
        at = np.minimum(np.searchsorted(self.terms, w.hashes), len(self.terms) - 1)
        known = self.terms[at] == w.hashes
        for i, a, b in self._passages(w.cuts, at, known):
            lo, hi = int(w.cuts[i]), int(w.cuts[i + 1])
            for probe, score in self.wand(np.unique(at[a:b][known[a:b]]).tolist()):
                item = self.item_of[probe]
                if item in out[i] and out[i][item][0] >= score:
                    continue
                reach = sum(map(len, self.parts[item])) + 2 * SHINGLE
                around = w.hashes[max(lo, a - reach) : min(hi, b + reach)]
                near = self._overlaps(around, self.parts[item])
                if self.whole[item]:
                    near = max(near, self._overlaps(around, self.whole[item]), key=min)
                if min(near) >= OVERLAP:
                    out[i][item] = (score, *near)
        return out

    def _passages(self, cuts: np.ndarray, at: np.ndarray, known: np.ndarray):
        """(text, first word, end) of the passages that some item's essential terms lift to NEEDED.

        Texts are cut into stretches of ``longest`` words; a passage is two
        stretches on end, so a copy of a probe lies whole in one.
        """
        n, probes = self.longest, len(self.item_of)
        # Numbers of stretches, with one left free after each text.
        stretches = -(-np.diff(cuts) // n) + 1
        base = np.cumsum(stretches) - stretches
        words = np.nonzero(known)[0]
        terms = at[words]
        sizes = self.essential_cuts[terms + 1] - self.essential_cuts[terms]
        words, terms = words[sizes > 0], terms[sizes > 0]
        sizes = sizes[sizes > 0]
        if not len(words):
            return
        text = np.searchsorted(cuts, words, "right") - 1
        stretch = base[text] + (words - cuts[text]) // n
        row = np.repeat(self.essential_cuts[terms] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        key = np.repeat(stretch, sizes) * probes + self.essential[0][row]
        order = np.argsort(key, kind="stable")
        key, weight = key[order], self.essential[1][row][order]
        first = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
        key, total = key[first], np.add.reduceat(weight, first)
        after = np.minimum(np.searchsorted(key, key + probes), len(key) - 1)
        both = total + np.where(key[after] == key + probes, total[after], 0.0)
        # A word counts as often as it stands there, so this bounds the score from above.
        # If a stretch does it alone, the copy may begin in the one before.
        hopeful = np.concatenate([key[both >= NEEDED - 1e-9] // probes, key[total >= NEEDED - 1e-9] // probes - 1])
        for s in np.unique(hopeful[hopeful >= 0]).tolist():
            i = int(np.searchsorted(base, s, "right")) - 1
            a = int(cuts[i]) + (s - int(base[i])) * n
            if a < cuts[i + 1]:
                yield i, a, min(a + 2 * n, int(cuts[i + 1]))

    def _overlaps(self, hashes: np.ndarray, parts: list[np.ndarray]) -> tuple[float, float]:
        """Shares of the question's and the answer's shingles among those of ``hashes``."""
        runs = self._shingles(hashes)
        # A part shorter than a shingle is one hash of all its words: compared with runs of every length.
        shares = []
        for part in parts:
            share = float(np.isin(part, runs).mean()) if len(part) else 1.0
            if len(part) == 1 and share == 0.0:
                for size in range(1, SHINGLE):
                    with np.errstate(over="ignore"):
                        x = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
                        for k in range(size):
                            x = mix(x * np.uint64(31) + hashes[k : len(hashes) - size + 1 + k])
                    if np.isin(part, x).any():
                        share = 1.0
            shares.append(share)
        return shares[0], shares[1]


def _slices(items: DataFrame):
    held, size = [], 0
    for r in items.select(F.col("item_id").cast("long").alias("i"), F.coalesce("text", F.lit("")).alias("t")).orderBy("i", "t").toLocalIterator():
        n = len(r["t"].encode("utf-8", "surrogatepass"))
        if held and (len(held) == SLICE or size + n > SLICE_BYTES):
            yield held
            held, size = [], 0
        held.append((r["i"], r["t"]))
        size += n
    if held:
        yield held


def _passes(spark: SparkSession, items: DataFrame):
    """Lists of broadcast indexes, one list a pass."""
    found = []
    for some in _slices(items):
        found.append(spark.sparkContext.broadcast(Index(some)))
        if len(found) == AT_ONCE:
            yield found
            found = []
    if found:
        yield found


def _searched(batches, index: Index, column: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            yield part, index.search([t or "" for t in part.column(column).to_pylist()])


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: every leaked item of every document.

    Null texts and items without words match nothing; of rows with one doc_id the
    one with the highest score is shown for an item, likewise of items with one
    item_id.
    """
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    found = docs.sparkSession.createDataFrame([], schema)
    for indexes in _passes(docs.sparkSession, items):

        def find(batches, indexes=indexes):
            for batch in batches:
                for index in indexes:
                    for part, leaks in _searched([batch], index.value, 1):
                        rows = [(d, index.value.items[k], *v) for d, x in zip(part.column(0).to_pylist(), leaks) for k, v in x.items()]
                        cols = list(zip(*rows)) if rows else [()] * 5
                        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.float64()) for c in cols[2:])], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.unionByName(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(find), schema))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("x"))
    return best.select("doc_id", "item_id", *[F.round(f"x.{c}", 6).alias(c) for c in ("score", "question_overlap", "answer_overlap")])


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no leaked item, each judged on its own text."""
    columns, kind = docs.columns, docs.select(F.struct(*docs.columns).alias("row")).schema["row"].dataType.simpleString()
    for indexes in _passes(docs.sparkSession, items):

        def keep(batches, indexes=indexes):
            for part in batches:
                for index in indexes:
                    left = [(p, pa.array([not x for x in leaks], pa.bool_())) for p, leaks in _searched([part], index.value, 1)]
                    part = pa.Table.from_batches([p.filter(clean) for p, clean in left], part.schema).combine_chunks()
                    part = part.to_batches()[0] if part.num_rows else pa.RecordBatch.from_pylist([], part.schema)
                yield pa.RecordBatch.from_arrays([part.column(0)], ["row"])

        docs = docs.select(F.struct(*columns).alias("row"), "text").mapInArrow(tidy(keep), f"row {kind}").select("row.*")
    return docs


def op9_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
