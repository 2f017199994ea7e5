"""Removal of repeated passages: windows of ``WINDOW`` words that an earlier document holds too.

1. A phrase is ``PHRASE`` consecutive words.  Of the phrases inside a window the
   one with the least hash is its anchor; it depends on the window's words
   alone, so equal windows have equal anchors.  About one position in thirteen
   is an anchor of some window.  Every document posts its anchors' hashes; those
   that two documents post are candidates.
2. Candidates are confirmed: the words of the phrase are read from its first and
   its last holder.  The confirmed phrases, as words, are what automata hold.
3. Documents are dealt into shards by the first holder of their phrases, so that
   copies meet, and a shard is split where it has too many words.  A shard's
   Aho-Corasick automaton has the phrases that any of its documents may hold;
   the hashes may send too many, the automaton decides.  Each document is
   streamed over its shard's automaton, word for word, and the matches are the
   occurrences.  Documents that post no candidate hold no recurring phrase.  The
   windows around an anchor's occurrence are its segment.
4. Equal segments collapse to one row with the smallest doc_id.  Where a phrase
   has segments that differ - the edges of a passage, copies with edits - their
   windows are compared one by one, again as counts per distinct window.

Windows are told apart by their anchor's and their own 64-bit hashes together.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .common import stage, table, tidy, trim_memory
from .words import mix, ragged, split_words, windows

WINDOW = 50
PHRASE = 26
#: Words in a shard, about; a longer document is a shard by itself.
SHARD_WORDS = 500_000
#: Bits of a word's number in one character of the automaton's text.
DIGIT_BITS = 6
#: Shares of the segments of one phrase, so that a phrase in very many documents is compared by several tasks.
SALT = 8


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of ``size``, by doubling."""
    done = 1
    while 2 * done <= size:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = size - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(hashes: np.ndarray, cuts: np.ndarray, window: int, phrase: int):
    """The runs of windows with one anchor, of many documents at once.

    For each run: its document, anchor's hash and place, first window and number
    of windows; windows and places are counted over all words.
    """
    none = np.zeros(0, np.int64)
    span = window - phrase + 1
    if len(hashes) < window:
        return none, np.zeros(0, np.uint64), none, none, none
    grams = windows(hashes, phrase)
    least = _sliding_min(grams, span)
    doc = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    valid = np.nonzero(doc[: len(least)] == doc[window - 1 :])[0]
    if not len(valid):
        return none, np.zeros(0, np.uint64), none, none, none
    of = least[valid]
    at = np.nonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (valid[1:] != valid[:-1] + 1) | (doc[valid[1:]] != doc[valid[:-1]])]))[0]
    first = valid[at]
    place = first + grams[first[:, None] + np.arange(span)].argmin(axis=1)
    return doc[first], of[at], place, first, np.diff(np.concatenate([at, [len(valid)]]))


def _rows(batches, rows: int):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), text: rows with both alike are the same document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))


def _fingerprints(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    def find(batches):
        for batch in _rows(batches, 1000):
            w = split_words(batch.column(2))
            doc, fp, _, _, _ = anchors(w.hashes, w.cuts, window, phrase)
            if len(doc):
                order = np.lexsort((fp, doc))
                doc, fp = doc[order], fp[order]
                once = np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])])
                at = pa.array(doc[once])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(fp[once].view(np.int64))], ["doc_id", "th", "fp"])

    return docs.filter("doc_id is not null").mapInArrow(tidy(find), "doc_id long, th long, fp long")


def word_codes(*columns) -> list[np.ndarray]:
    """Numbers from 1 for the words of several ``Words``: equal numbers, equal words."""
    sizes = np.concatenate([w.ends - w.starts for w in columns])
    raw = np.concatenate([w.raw[ragged(w.starts, w.ends - w.starts)] for w in columns])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    return np.split(codes, np.cumsum([len(w.starts) for w in columns])[:-1])


def locate(codes: np.ndarray, cuts: np.ndarray, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases occur in the documents of a shard: places, ascending, and numbers of the phrases.

    ``codes``: the words of all documents as numbers from 1; ``phrases``: one
    phrase a row.  One automaton, one pass; a character that no phrase has
    stands between documents.
    """
    import ahocorasick

    none = np.zeros(0, np.int64)
    if not len(phrases) or not len(codes):
        return none, none
    size = phrases.shape[1]
    n_docs = len(cuts) - 1
    # Word k of document d is at k + d: a word that no phrase has stands after each document.
    doc = np.repeat(np.arange(n_docs), np.diff(cuts))
    spaced = np.zeros(len(codes) + n_docs, np.int64)
    spaced[np.arange(len(codes)) + doc] = codes
    # A word is a few characters, each place with its own small alphabet: nodes have few
    # children, which the automaton looks through one by one, and matches keep to words.
    width = -(-max(int(codes.max()), int(phrases.max())).bit_length() // DIGIT_BITS)

    def spelled(words: np.ndarray) -> str:
        text = np.empty((len(words), width), "<u4")
        for k in range(width):
            text[:, k] = (words >> DIGIT_BITS * k) & ((1 << DIGIT_BITS) - 1) | k << DIGIT_BITS
        return text.tobytes().decode("utf-32-le")

    whole, all_phrases = spelled(spaced), spelled(phrases.ravel())
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k in range(len(phrases)):
        automaton.add_word(all_phrases[k * size * width : (k + 1) * size * width], k)
    automaton.make_automaton()
    found = np.fromiter(chain.from_iterable(automaton.iter(whole)), np.int64).reshape(-1, 2)
    begin = (found[:, 0] + 1) // width - size
    return begin - np.searchsorted(cuts[1:] + np.arange(1, n_docs + 1), begin, "right"), found[:, 1]


_ODD = np.uint64(0x2545F4914F6CDD1D)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))


def _span_hashes(hashes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """One hash for each run of words, from prefix sums."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        steps, back = np.full(n, _ODD, np.uint64), np.full(n, _ODD_INVERSE, np.uint64)
        if n:
            steps[0] = back[0] = 1
        steps, back = np.multiply.accumulate(steps), np.multiply.accumulate(back)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * steps)])
        return mix((sums[first + length] - sums[first]) * back[first] + length.astype(np.uint64))


_SEGMENTS = "doc_id long, th long, fp long, first int, segment long, hashes array<long>"


def _phrases(held: DataFrame, window: int, phrase: int) -> DataFrame:
    """(fp, words) of the candidates in ``own``, read from the text; ``held``: text, own."""

    def read(batches):
        for batch in _rows(batches, 1000):
            w = split_words(batch.column(0))
            doc, fp, place, _, _ = anchors(w.hashes, w.cuts, window, phrase)
            lists = batch.column(1)
            own = np.sort(_pair(np.repeat(np.arange(batch.num_rows), np.diff(np.array(lists.offsets))), np.array(lists.flatten()).view(np.uint64)))
            mine = _pair(doc, fp)
            place, fp = place[np.isin(mine, own)], fp[np.isin(mine, own)]
            once = np.unique(fp, return_index=True)[1]
            data = w.raw.tobytes()
            words = [b" ".join([data[a:b] for a, b in zip(w.starts[p : p + phrase].tolist(), w.ends[p : p + phrase].tolist())]) for p in place[once].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(fp[once].view(np.int64)), pa.array(words, pa.binary()).cast(pa.string())], ["fp", "words"])

    return held.select("text", "own").mapInArrow(tidy(read), "fp long, words string").distinct()


def _pair(doc: np.ndarray, fp: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(fp ^ mix(doc.astype(np.uint64) + np.uint64(1)))


def shard_segments(docs: pa.Table, known: pa.Table, window: int, phrase: int) -> pa.Table:
    """The windows around every occurrence of the ``known`` phrases (fp, words) in ``docs`` (doc_id, th, text)."""
    w, p = split_words(docs.column("text")), split_words(known.column("words"))
    codes, spelled = word_codes(w, p)
    places, which = locate(codes, w.cuts, spelled.reshape(-1, phrase))
    there = np.zeros(len(codes) + 1, np.int64)
    there[places] = which + 1
    doc, _, place, first, count = anchors(w.hashes, w.cuts, window, phrase)
    hit = there[place] > 0
    doc, place, first, count = doc[hit], place[hit], first[hit], count[hit]
    fp = known.column("fp").to_numpy()[there[place] - 1]
    each = windows(w.hashes, window).view(np.int64)
    offsets = np.concatenate([[0], np.cumsum(count)])
    hashes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(each[ragged(first, count)]))
    segment = _span_hashes(w.hashes, first, count + window - 1)
    at = pa.array(doc)
    return pa.table([docs.column("doc_id").take(at), docs.column("th").take(at), pa.array(fp, pa.int64()), pa.array((first - w.cuts[doc]).astype(np.int32)), pa.array(segment.view(np.int64)), hashes], ["doc_id", "th", "fp", "first", "segment", "hashes"])


def _segments(shards: DataFrame, phrases: DataFrame, window: int, phrase: int) -> DataFrame:
    """``shard_segments`` of every shard; ``shards``: shard, doc_id, th, text; ``phrases``: of (the shard), fp, words."""

    def shard(docs: pa.Table, known: pa.Table) -> pa.Table:
        out = shard_segments(docs, known, window, phrase)
        trim_memory()
        return out

    return shards.groupBy("shard").cogroup(phrases.groupBy("of")).applyInArrow(shard, _SEGMENTS)


def _dealt(affected: DataFrame) -> DataFrame:
    """doc_id, th, fps, shard: documents with one lead go together, as many shards a lead or leads a shard as their texts ask for."""
    size = 6 * SHARD_WORDS
    slim = affected.select("doc_id", "th", "fps", "lead", "n")
    total = slim.agg(F.sum("n")).first()[0] or 0
    leads = slim.groupBy("lead").agg(F.sum("n").alias("all")).withColumn("parts", F.ceil(F.col("all") / size).cast("int"))
    own = F.pmod(F.xxhash64("doc_id", "th"), "parts")
    common = F.pmod(F.xxhash64("lead"), F.lit(max(1, total // size)))
    shard = F.when(F.col("parts") > 1, F.xxhash64("lead", own)).otherwise(common)
    return slim.join(stage(leads, "leads"), "lead").select("doc_id", "th", "fps", shard.alias("shard"))


def _removed_windows(segments: DataFrame) -> DataFrame:
    """doc_id, th, spans: (first, last) of window starts to remove, for documents that lose any."""
    variants = segments.groupBy("fp", "segment").agg(F.min("doc_id").alias("first_doc"), F.first("hashes").alias("hashes"))
    variants = stage(variants, "variants")
    several = variants.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp")
    salted = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    each = variants.withColumn("salt", F.pmod("segment", F.lit(SALT)).cast("int")).join(salted, ["fp", "salt"], "left_semi")
    each = each.select("fp", "segment", "first_doc", F.posexplode("hashes").alias("k", "h"))
    # Written, so that the join has two shuffled sides and a window that very many variants hold can be split.
    earliest = stage(each.groupBy("fp", "h").agg(F.min("first_doc").alias("lo"), F.max("first_doc").alias("hi")).filter("lo < hi").select("fp", "h", "lo"), "earliest")
    inside = each.join(earliest, ["fp", "h"]).filter("lo < first_doc").groupBy("fp", "segment").agg(F.collect_set("k").alias("ks"))
    # One join of the many rows with the distinct ones, so that a segment with very many holders can be split.
    judged = variants.select("fp", "segment", "first_doc").join(inside, ["fp", "segment"], "left")
    judged = stage(judged, "judged")
    mine = segments.select("doc_id", "th", "fp", "segment", "first", F.size("hashes").alias("n")).join(judged, ["fp", "segment"])
    # Later holders of a segment lose all of its windows, the first one those that another segment had before.
    ks = F.when(F.col("doc_id") > F.col("first_doc"), F.array(F.struct(F.col("first").alias("a"), (F.col("first") + F.col("n") - 1).alias("b"))))
    ks = ks.otherwise(F.transform(F.coalesce("ks", F.array().cast("array<int>")), lambda k: F.struct((F.col("first") + k).alias("a"), (F.col("first") + k).alias("b"))))
    spans = mine.select("doc_id", "th", ks.alias("x")).filter("size(x) > 0")
    return spans.groupBy("doc_id", "th").agg(F.array_distinct(F.flatten(F.collect_list("x"))).alias("spans"))


def _cover(spans: list, n: int, window: int) -> np.ndarray:
    gone = np.zeros(n + 1, np.int64)
    for s in spans:
        gone[s["a"]] += 1
        gone[min(n, s["b"] + window)] -= 1
    return np.cumsum(gone)[:n] > 0


def _kept(batches, window: int, removed: bool):
    """doc_id, th, n_words, n_removed, kept (words joined by a space) and its digest."""
    for batch in _rows(batches, 1000):
        w = split_words(batch.column(2))
        data, spans = w.raw.tobytes(), batch.column(3).to_pylist() if removed else [None] * batch.num_rows
        n_words, n_removed, kept = [], [], []
        for i, x in enumerate(spans):
            lo, hi = int(w.cuts[i]), int(w.cuts[i + 1])
            places = np.arange(lo, hi)
            if x:
                places = places[~_cover(x, hi - lo, window)]
            n_words.append(hi - lo)
            n_removed.append(hi - lo - len(places))
            kept.append(b" ".join([data[a:b] for a, b in zip(w.starts[places].tolist(), w.ends[places].tolist())]))
        shas = [hashlib.sha256(k).hexdigest() for k in kept]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(shas)], ["doc_id", "th", "n_words", "n_removed", "kept_text", "kept_sha256"])


_KEPT = "doc_id long, th long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, phrase: int = PHRASE, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (if ``texts``), kept_sha256 of every row.

    Null text has no words.  Only a strictly smaller doc_id counts as earlier,
    so rows of one doc_id keep what they share; rows without a doc_id neither
    lose words nor take any.
    """
    if not 0 < phrase <= window:
        raise ValueError("phrase must be between 1 and window")
    keyed = _keyed(docs)
    prints = _fingerprints(keyed, window, phrase)
    recurring = prints.groupBy("fp").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    mine = prints.join(stage(recurring, "recurring"), "fp").groupBy("doc_id", "th").agg(
        F.collect_set("fp").alias("fps"), F.collect_set(F.when(F.col("doc_id").isin(F.col("lo"), F.col("hi")), F.col("fp"))).alias("own"), F.min("lo").alias("lead")
    )
    affected = stage(keyed.dropDuplicates(["doc_id", "th"]).join(mine, ["doc_id", "th"]).withColumn("n", F.length("text")), "affected")
    dealt = stage(_dealt(affected), "dealt")
    phrases = stage(_phrases(affected.filter("size(own) > 0"), window, phrase), "phrases")
    wanted = dealt.select("shard", F.explode("fps").alias("fp")).distinct().join(phrases, "fp").select(F.col("shard").alias("of"), "fp", "words")
    located = _segments(dealt.select("shard", "doc_id", "th").join(affected.select("doc_id", "th", "text"), ["doc_id", "th"]), wanted, window, phrase)
    spans = _removed_windows(stage(located, "segments"))
    columns = ["doc_id", "n_words", "n_removed", *(["kept_text"] if texts else []), "kept_sha256"]
    changed = affected.select("doc_id", "th", "text").join(spans, ["doc_id", "th"]).mapInArrow(tidy(lambda b: _kept(b, window, True)), _KEPT)
    changed = stage(changed.select("th", *columns), "changed")
    same = keyed.mapInArrow(tidy(lambda b: _kept(b, window, False)), _KEPT).select("th", *columns)
    new = changed.select("doc_id", "th", *[F.col(c).alias(f"new_{c}") for c in columns[2:]])
    out = same.join(new, ["doc_id", "th"], "left")
    return out.select("doc_id", "n_words", *[F.coalesce(f"new_{c}", c).alias(c) for c in columns[2:]])


def op4_repeated_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False)
