"""Personal data: base patterns, then bootstrapped contextual extraction.

The base patterns find e-mail, ip, card and phone spans; these are seeds, and so
are key-like values (long, letters and digits mixed) and given identifiers.
The words before and after seeds induce lexical patterns (the nearest word, the
nearest two).  Pattern and instance - a seed, or any other token whose shape
lets it be an identifier - form a graph that Spark scores in rounds: a pattern's
confidence is the share of its occurrences in the corpus at which a trusted
instance stands, an instance's score is the noisy-or of the confidences of its
patterns, times a score of its shape.  Instances above ``TRUSTED`` join the
seeds of the next round, where they also induce patterns, until a round adds
none; then every occurrence of a trusted instance that no base span covers is
an ``id`` span.  So a key-like value counts as evidence at once, but becomes a
span only behind a pattern.

A pattern counts only if ``SUPPORT`` different seeds or trusted instances stand
at it, or, where no seed does, ``DISTINCT`` different identifier-like values at
nearly all of its occurrences.  Its occurrences at ordinary words count against
it, so "of the" never becomes one, however often it precedes a seed.
"""

from __future__ import annotations

import hashlib
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .common import BROADCAST_ROWS, maybe_broadcast, stage, table, tidy
from .words import split_words, string_buffers

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
TRUSTED = 0.8
#: Different values that make a pattern without seeds count, if they stand at this share of its occurrences.
DISTINCT, ALWAYS = 10, 0.9
#: Patterns below this confidence say nothing about an instance, however many there are.
TELLING = 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Digit runs are taken whole, so a long run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._/-]*[0-9A-Za-z]")
#: Quotes, brackets and their like part context words as white space does; other ASCII punctuation ends one, as in "id=" and "no.".
_PARTING = "\x20\t\n\x0b\x0c\r\"'`()[]{}<>|*\\"
_MARKS = "!#$%&,-./:;=?@^~"
_WORD = re.compile(f"[^{re.escape(_PARTING + _MARKS)}]+[{re.escape(_MARKS)}]*|[{re.escape(_MARKS)}]+")
_PART_BYTES = np.isin(np.arange(256), list(_PARTING.encode()))
_MARK_BYTES = np.isin(np.arange(256), list(_MARKS.encode()))
_NOT_DIGIT = re.compile("[^0-9]")
#: Every token that can be an identifier has one of these.
_TELLTALE = re.compile("[0-9_]|(?<=[a-z])[A-Z]")
_RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._/-")
_BYTES = np.arange(256)
_SIGN_BYTES, _UPPER_BYTES, _LOWER_BYTES = np.isin(_BYTES, list(b"0123456789_@")), (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122)
#: What a pattern after its instance starts with; no word holds it.
AFTER = "\0"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches: at each @, the run of local characters before it, back to the last match at most."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        # A failed run can't be part of a later match: those start after its @.
        done = m.end() if m else at + 1
        if m:
            yield start, m.end()
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def spelled(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _pattern(words: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(words).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _lower(word: str) -> str:
    return word.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def context_words(column: pa.Array) -> pa.Array:
    """``column`` with the words of ``contexts`` parted by blanks, so that ``split_words`` finds just these."""
    raw, offs = string_buffers(column)
    raw = np.where(_PART_BYTES[raw], np.uint8(32), raw)
    part = np.nonzero(_MARK_BYTES[raw[:-1]] & ~_MARK_BYTES[raw[1:]] & (raw[1:] != 32))[0] + 1
    offs = offs + np.searchsorted(part, offs)
    raw = np.insert(raw, part, 32)
    return pa.Array.from_buffers(pa.large_string(), len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())])


def shape(token: str) -> float:
    """How far the look of a token lets it be an identifier; 0 for ordinary words and short numbers."""
    digits = len(_NOT_DIGIT.sub("", token))
    if digits >= 6 or key_like(token):
        return 1.0
    if digits >= 4 or digits and len(token) >= 5 and digits < len(token):
        return 0.95
    mixed = "_" in token or any(a.islower() and b.isupper() for a, b in zip(token, token[1:]))
    return 0.85 if mixed and len(token) >= 5 else 0.0


def key_like(token: str) -> bool:
    """Long, of many different characters, letters and digits mixed."""
    digits = len(_NOT_DIGIT.sub("", token))
    return len(token) >= 20 and digits >= 4 and sum(c.isalpha() for c in token) >= 4 and len(set(token.lower())) >= 9


def instances(text: str, spans, known: frozenset = frozenset()) -> list[tuple[int, int, str, bool, bool, list[list[str]]]]:
    """Seeds and identifier-like tokens: start, end, text, whether of a base span, whether a seed, contexts.

    A context is the nearest whole word before, or after, and the nearest two.  A
    word is the context of one instance on each side only, so no pattern stands
    at more instances than it occurs.
    """
    found = [(a, b, text[a:b], True, True) for _, a, b in spans]
    covered: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(b, covered[-1][1])
        else:
            covered.append([a, b])
    k = 0
    for a, b in _token_spans(text) if not known else (m.span() for m in _TOKEN.finditer(text)):
        token = text[a:b]
        given = token in known
        if not given and not shape(token):
            continue
        while k < len(covered) and covered[k][1] <= a:
            k += 1
        if k == len(covered) or b <= covered[k][0]:
            found.append((a, b, token, False, given or key_like(token)))
    used, out = set(), []
    for a, b, value, base, seed in found:
        patterns = []
        for near, mark in ((_words_before(text, a), ()), (_words_after(text, b), (AFTER,))):
            if near and (mark, near[0]) not in used:
                used.add((mark, near[0]))
                words = [_lower(text[x:y]) for x, y in near]
                # Nearest first; a pattern has them in the order of the text.
                patterns += [[*mark, *(words[:n] if mark else words[n - 1 :: -1])] for n in (1, 2) if len(words) >= n]
        out.append((a, b, value, base, seed, patterns))
    return out


def _token_spans(text: str):
    """The spans of ``_TOKEN`` that hold a telltale character; the rest of the text is passed over."""
    done = 0
    for m in _TELLTALE.finditer(text):
        at = m.start()
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in _RUN:
            start -= 1
        t = _TOKEN.search(text, start)
        if t is None:
            return
        done = max(done, at + 1)
        if t.start() <= at:
            done = t.end()
            yield t.span()


def _goes_on(text: str, at: int) -> bool:
    """Whether one word reaches over ``at``."""
    if not 0 < at < len(text) or text[at - 1] in _PARTING or text[at] in _PARTING:
        return False
    return text[at] in _MARKS or text[at - 1] not in _MARKS


def _words_before(text: str, start: int) -> list[tuple[int, int]]:
    """Spans of the last two whole words that end at ``start`` or before, the nearest first."""
    back = 64
    while True:
        lo = max(0, start - back)
        found = [m.span() for m in _WORD.finditer(text, lo, start)]
        if found and found[0][0] == lo and lo:
            found = found[1:]  # may begin further back
        if found and found[-1][1] == start and _goes_on(text, start):
            found.pop()
        if len(found) >= 2 or not lo:
            return found[-2:][::-1]
        back *= 4


def _words_after(text: str, end: int) -> list[tuple[int, int]]:
    """Spans of the first two whole words that begin at ``end`` or later."""
    cut = _goes_on(text, end)
    return [m.span() for m in islice(_WORD.finditer(text, end), cut, cut + 2)]


_FOUND = "array<struct<start:int,end:int,value:string,shape:double,base:boolean,seed:boolean,patterns:array<long>,words:array<string>>>"


def _signs(column: pa.Array) -> list[bool]:
    """Whether a row has a character without which it has neither base spans nor tokens like identifiers."""
    raw, offs = string_buffers(column)
    sign = _SIGN_BYTES[raw]
    sign[1:] |= _UPPER_BYTES[raw[1:]] & _LOWER_BYTES[raw[:-1]]
    return (np.diff(np.searchsorted(np.nonzero(sign)[0], offs)) > 0).tolist()


def _scan(docs: DataFrame, row_type: str, known: frozenset) -> DataFrame:
    """row (as given), n_* of the base spans, spans, found."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("shape", pa.float64()), ("base", pa.bool_()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.int64())), ("words", pa.list_(pa.string()))]))

    def scan(batches):
        for batch in batches:
            spans, found, signs = [], [], _signs(batch.column(1))
            for text, any_sign in zip(batch.column(1).to_pylist(), signs):
                if not any_sign and not known:
                    spans.append([]), found.append([])
                    continue
                own = base_spans(text or "")
                spans.append(own)
                found.append([{"start": a, "end": b, "value": v, "shape": shape(v), "base": base, "seed": s, "patterns": [_pattern(w) for w in c], "words": [" ".join(w) for w in c]} for a, b, v, base, s, c in instances(text or "", own, known)])
            counts = [pa.array([sum(s[0] == k for s in own) for own in spans], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(map(spelled, spans), pa.string()), pa.array(found, kind)], ["row", *(f"n_{k}" for k in KINDS), "base", "found"])

    return docs.mapInArrow(tidy(scan), f"row {row_type}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, found {_FOUND}")


def _totals(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): occurrences of each pattern's words in the corpus.

    Few patterns go to every task; more than ``BROADCAST_ROWS`` are counted by a
    shuffle of per-batch counts instead.
    """
    spark = texts.sparkSession
    listed = patterns.select("pattern", "words").limit(BROADCAST_ROWS + 1).collect()
    everything = len(listed) > BROADCAST_ROWS

    def key(column):
        w = split_words(context_words(column), lower=True)
        one = w.hashes
        doc = w.doc_of_word()
        with np.errstate(over="ignore"):
            two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ one[1:] * np.uint64(0xC2B2AE3D27D4EB4F))[doc[:-1] == doc[1:]]
        return one, two

    def hashed(words: list[str]) -> np.ndarray:
        words = [w.removeprefix(AFTER + " ") for w in words]
        out = np.zeros(len(words), np.uint64)
        for n, pick in ((1, 0), (2, 1)):
            at = [i for i, w in enumerate(words) if w.count(" ") == n - 1]
            if at:
                out[at] = key(pa.array([words[i] for i in at]))[pick]
        return out

    wanted = None if everything else np.sort(hashed([r["words"] for r in listed]))

    def count(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                parts = []
                for h in key(batch.column(0).slice(lo, 1000)):
                    if wanted is not None:
                        at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                        h = h[wanted[at] == h]
                    parts.append(h)
                h, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    totals = texts.mapInArrow(tidy(count), "h long, n long").groupBy("h").agg(F.sum("n").alias("total"))

    def name(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashed(batch.column(1).to_pylist()).view(np.int64))], ["pattern", "h"])

    named = patterns.select("pattern", "words").mapInArrow(tidy(name), "pattern long, h long")
    return named.join(totals, "h").select("pattern", "total")


def discover(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(value, score) of trusted instances; ``found``: (value, shape, base, seed, pattern, words), a row an occurrence and pattern.

    Trusted instances only ever add support and confidence, so a round that adds none is the last.
    """
    edges = found.groupBy("pattern", "value").agg(F.max("shape").alias("shape"), F.min("base").alias("base"), F.max("seed").alias("seed"), F.count("*").alias("n"), F.first("words").alias("words"))
    able = edges.groupBy("pattern").agg(F.count("*").alias("values"), F.count_if(~F.col("base")).alias("others"))
    able = able.filter((F.col("values") >= SUPPORT) & (F.col("others") > 0)).select("pattern")
    edges = stage(edges.join(maybe_broadcast(stage(able, "able")), "pattern", "left_semi"), "edges")
    trusted, n_trusted, totals = edges.sparkSession.createDataFrame([], "value string, score double"), 0, None
    while True:
        marked = edges.join(maybe_broadcast(trusted.select("value", F.lit(True).alias("known"))), "value", "left")
        mine = F.col("seed") | F.coalesce("known", F.lit(False))
        backed = marked.groupBy("pattern").agg(
            F.count_if(mine).alias("support"), F.sum(F.when(mine, F.col("n"))).alias("hits"), F.count_if(F.col("shape") == 1).alias("values"), F.sum(F.when(F.col("shape") == 1, F.col("n"))).alias("shaped"), F.first("words").alias("words")
        )
        backed = stage(backed.filter((F.col("support") >= SUPPORT) | (F.col("values") >= DISTINCT)), "patterns")
        fresh = backed if totals is None else backed.join(totals, "pattern", "left_anti")
        if not fresh.isEmpty():
            counted = stage(_totals(texts, fresh), "totals")
            totals = counted if totals is None else totals.unionByName(counted)
        if totals is None:
            return trusted
        alone = F.when((F.col("values") >= DISTINCT) & (F.col("shaped") >= ALWAYS * F.col("total")), F.col("shaped") / F.col("total"))
        seeded = F.when(F.col("support") >= SUPPORT, F.col("hits") / F.col("total"))
        confidence = backed.join(totals, "pattern").select("pattern", F.greatest(seeded, alone).alias("confidence")).filter(F.col("confidence") >= TELLING)
        miss = F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))
        scored = edges.filter("not base").join(maybe_broadcast(stage(confidence, "confidence")), "pattern").groupBy("value").agg(((1 - F.exp(F.sum(miss))) * F.max("shape")).alias("score"))
        trusted = stage(scored.filter(F.col("score") >= TRUSTED), "trusted")
        n = trusted.count()
        if n <= n_trusted:
            return trusted
        n_trusted = n


def _all_spans(scanned: DataFrame, texts: DataFrame) -> DataFrame:
    """rid, ids: the discovered spans of documents that have any."""
    one = scanned.select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    occurrences = one.select("value", "shape", "base", "seed", F.explode(F.arrays_zip("patterns", "words")).alias("p"))
    occurrences = occurrences.select("value", "shape", "base", "seed", F.col("p.patterns").alias("pattern"), F.col("p.words").alias("words"))
    values = discover(occurrences, texts)
    spans = one.filter("not base").join(maybe_broadcast(values.select("value")), "value", "left_semi")
    return spans.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ids"))


def _finished(docs: DataFrame, known=()) -> DataFrame:
    """row, n_* and spans of every row of ``docs`` (row, text)."""
    kind = docs.schema["row"].dataType.simpleString()
    scanned = stage(_scan(docs, kind, frozenset(known)).withColumn("rid", F.monotonically_increasing_id()), "scanned")
    ids = maybe_broadcast(_all_spans(scanned, docs.select(F.coalesce("text", F.lit("")).alias("text"))))
    more = F.array_join(F.transform("ids", lambda s: F.concat(F.lit("id:"), s["start"], F.lit(":"), s["end"])), ",")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), more)
    return scanned.join(ids, "rid", "left").select("row", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"))


def find_personal_data(docs: DataFrame, *, known=()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (of the base spans), base_sha256, spans of every row.

    ``known``: given identifiers, a stated list; they are seeds too.  Null text is empty. ``spans`` has the base spans by kind, then the
    discovered ones as kind ``id``. Repeated rows are found alike.
    """
    out = _finished(docs.select(F.col("doc_id").cast("long").alias("row"), "text"), known)
    return out.withColumnRenamed("row", "doc_id")


def mask_personal_data(docs: DataFrame, *, known=()) -> DataFrame:
    """``docs`` with every span replaced by ``<kind>``; overlapping spans become one, named by the first; n_chars follows."""
    columns = docs.columns
    found = _finished(docs.select(F.struct(*columns).alias("row"), "text"), known)

    def mask(batches):
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text is not None and spans:
                    parts, at = [], 0
                    marks = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",")))
                    for a, b, k in marks:
                        if a >= at:
                            parts += [text[at:a], f"<{k}>"]
                        at = max(at, b)
                    text = "".join(parts) + text[at:]
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "masked"])

    kind = found.schema["row"].dataType.simpleString()
    masked = found.select("row", "row.text", "spans").mapInArrow(tidy(mask), f"row {kind}, masked string")
    out = {c: F.col(f"row.{c}") for c in columns} | {"text": F.col("masked")}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("masked").isNotNull(), F.length("masked")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.select(*[c.alias(n) for n, c in out.items()])


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
