"""Near-duplicate classes by a signature-coordinate inverted join.

1. Every document gets the set of its distinct word shingles and a MinHash
   signature of ``COORDS`` coordinates.  Documents with one shingle set form a
   class; from here on a class is one row, however many copies it has.
2. Each class is posted under every (coordinate, value) pair.  Counts of the
   pairs tell which lists are longer than one; a class with fewer than
   ``MATCHES`` such lists cannot reach the threshold and is skipped.
3. Prefix merging: two classes that agree on ``MATCHES`` of the lists agree on
   one of the ``s - MATCHES + 1`` rarest of either's ``s`` lists, so only those
   stay.  Frequent lists - a passage that thousands share - drop out first.
4. Collisions are counted in rounds.  First every class is held against a few of
   the smallest classes of its lists; what that confirms collapses groups of near
   copies.  Then the lists that still hold several components are compared in
   blocks of ``BLOCK`` classes, whatever their length: once for each class's best
   partner in another component, so that components grow by a round of Boruvka's
   algorithm with rows in proportion to the lists, then for all pairs of
   different components that are left.
5. A pair is retained if its signatures agree in ``MATCHES`` posted coordinates
   and in ``AGREE`` of the extra ones, and confirmed on the full shingle sets.
   Both bounds miss a pair at the similarity threshold with probability below
   1e-6, see README.
6. Components of the confirmed links, by alternating star contraction.

No pair within a confirmed component is formed after the first round.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .common import maybe_broadcast, shrink_driver, stage, table, tidy
from .words import shingles, split_words

SHINGLE = 4
PERCENT = 80
COORDS = 64
MATCHES = 32
#: Further coordinates of two bits each, of the classes that are posted, only used to retain pairs.
#: Two of these agree with probability (1 + 3 * similarity) / 4.
EXTRA = 1792
AGREE = 1440
BLOCK = 512
#: Smallest classes of its lists that a class is held against in the first round.
PIVOTS = 4

_rng = np.random.Generator(np.random.PCG64(5))
_XOR = _rng.integers(0, 2**63, COORDS + EXTRA, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, COORDS + EXTRA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(items: np.ndarray, coords: slice) -> np.ndarray:
    """The given coordinates of the MinHash signature of a set."""
    flip, odd = _XOR[coords], _ODD[coords]
    out = np.full(len(odd), 2**64 - 1, np.uint64)
    rows = max(1, 131072 // len(odd))
    with np.errstate(over="ignore"):
        for at in range(0, len(items), rows):
            np.minimum(out, ((items[at : at + rows, None] ^ flip) * odd).min(axis=0), out=out)
    return out


def shingle_sets(column: pa.Array, size: int):
    """The sorted distinct shingle hashes of each row."""
    w = split_words(column, lower=True)
    for i in range(len(w.cuts) - 1):
        items = np.sort(shingles(w.hashes[w.cuts[i] : w.cuts[i + 1]], size))
        if len(items) > 1:
            items = items[np.concatenate([[True], items[1:] != items[:-1]])]
        yield items


def _digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _small(batches, rows: int = 1000):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def document_signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, node (digest of the set; null if empty), keys."""

    def sign(batches):
        for batch in _small(batches):
            n, node, keys = [], [], []
            for items in shingle_sets(batch.column(1), size):
                n.append(len(items))
                if not len(items):
                    node.append(None), keys.append(None)
                    continue
                node.append(_digest(items))
                keys.append(signature(items, slice(COORDS)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(keys, pa.binary())], ["doc_id", "th", "n_shingles", "node", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(tidy(sign), "doc_id long, th long, n_shingles long, node binary, keys binary")


def _post(classes: DataFrame) -> DataFrame:
    """(cid, key, coord) of every class and coordinate."""

    def post(batches):
        for batch in _small(batches, 4000):
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            coords = np.tile(np.arange(COORDS, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(batch.column(0)), COORDS)), pa.array(sigs), pa.array(coords)], ["cid", "key", "coord"])

    return classes.select("cid", "keys").mapInArrow(tidy(post), "cid long, key long, coord int")


def _prefixes(classes: DataFrame) -> DataFrame:
    """(cid, key, coord, mask) of the rarest shared lists, enough of them that no pair is lost; mask: the coordinates kept, as bits."""
    posted = _post(classes)
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    mine = posted.join(shared, "key").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("n", "key", "coord"))).alias("lists"))
    kept = mine.filter(F.size("lists") >= MATCHES).select("cid", F.expr(f"slice(lists, 1, size(lists) - {MATCHES} + 1)").alias("lists"))
    mask = F.expr("aggregate(lists, 0L, (m, x) -> m | shiftleft(1L, x.coord))")
    return kept.select("cid", mask.alias("mask"), F.explode("lists").alias("x")).select("cid", "x.key", "x.coord", "mask")


#: A class's row in comparisons: 32 bits of each posted coordinate, then the extra bits.
PROFILE = 4 * COORDS + EXTRA // 4
_PAIRS = np.uint64(0x5555555555555555)


def profile(items: np.ndarray) -> bytes:
    sig = signature(items, slice(None))
    posted, bits = (sig[:COORDS] >> np.uint64(24)).astype("<u4"), (sig[COORDS:] >> np.uint64(40)).astype(np.uint8) & 3
    fours = bits.reshape(-1, 4)
    return posted.tobytes() + (fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6).tobytes()


def _profiles(column: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(column), np.uint8).reshape(-1, PROFILE)
    return np.ascontiguousarray(both[:, : 4 * COORDS]).view("<u4"), np.ascontiguousarray(both[:, 4 * COORDS :]).view("<u8")


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many two-bit coordinates agree, by row."""
    differ = x ^ y
    return EXTRA - np.bitwise_count((differ | differ >> np.uint64(1)) & _PAIRS).sum(axis=1, dtype=np.int64)


def _first_pairs(prefix: DataFrame, profiles: DataFrame) -> DataFrame:
    """Each class with those of its lists' smallest classes, at most PIVOTS, that it meets most often and agrees with."""
    pivots = prefix.groupBy("key").agg(F.min("cid").alias("pivot"), F.count("*").alias("n")).filter("n > 1").select("key", "pivot")
    pairs = prefix.join(pivots, "key").filter("cid != pivot").groupBy("cid", "pivot").agg(F.count("*").alias("lists"))
    best = pairs.groupBy("cid").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("lists")).alias("lists"), "pivot"))), 1, PIVOTS).alias("best"))
    pairs = best.select("cid", F.explode("best.pivot").alias("pivot"))
    mine = profiles.select("cid", "profile")
    both = pairs.join(mine, "cid").join(mine.select(F.col("cid").alias("pivot"), F.col("profile").alias("other")), "pivot")

    def score(batches):
        for batch in _small(batches, 4000):
            (a, x), (b, y) = (_profiles(batch.column(c).to_pylist()) for c in ("profile", "other"))
            ok = pa.array(((a == b).sum(axis=1) >= MATCHES) & (_agreeing(x, y) >= AGREE))
            yield pa.RecordBatch.from_arrays([batch.column("cid").filter(ok), batch.column("pivot").filter(ok)], ["a", "b"])

    return both.select("cid", "pivot", "profile", "other").mapInArrow(tidy(score), "a long, b long")


#: Bits of a sieve for each row it is made of, and at most; beyond that it lets more through.
SIEVE_BITS = 32
SIEVE_MOST = 1 << 28


def _sieve(rows: DataFrame, keys: list[str]):
    """A function of (table, its keys, join type) that tells rows which may be among ``rows`` from those which are not.

    "left_semi" gives the first: all that are, and one in ``SIEVE_BITS`` of the
    others; "left_anti" gives the rest.  What is held against it is not
    shuffled: the sieve is a bitmap of hashes, broadcast.  ``rows`` must be
    staged, it is read twice.
    """
    size = min(max(SIEVE_BITS * rows.count(), 1 << 15), SIEVE_MOST)
    place = lambda of: F.pmod(F.xxhash64(*of), F.lit(size)) + 1
    bits = rows.select(F.bitmap_bucket_number(place(keys)).alias("__bucket"), F.bitmap_bit_position(place(keys)).alias("__at"))
    # Dealt before they are grouped, so that no task sends a bitmap for each bucket.
    bits = F.broadcast(bits.repartition("__bucket").groupBy("__bucket").agg(F.bitmap_construct_agg("__at").alias("__bits")))

    def through(df: DataFrame, of: list[str], how: str) -> DataFrame:
        at = F.bitmap_bit_position(place(of)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col("__bits"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
        hit = (F.col("__bucket") == F.bitmap_bucket_number(place(of))) & (F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1)
        return df.join(bits, hit, how)

    return through


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cid, n_shingles, items, profile) of the wanted classes: their texts are read again, one document a class and few others."""

    def build(batches):
        for batch in _small(batches):
            found = list(shingle_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays([pa.array([_digest(x) if len(x) else None for x in found], pa.binary()), pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary()), pa.array([profile(x) for x in found], pa.binary())], ["node", "n_shingles", "items", "profile"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    texts = _sieve(wanted, ["first.doc_id", "first.th"])(texts, ["doc_id", "th"], "left_semi")
    built = texts.select("doc_id", "text").mapInArrow(tidy(build), "node binary, n_shingles long, items binary, profile binary")
    # Repeated rows bring one set twice; the sets of documents that only passed the sieve find no class, or bring its own.
    return wanted.select("cid", "node").join(built, "node").groupBy("cid").agg(F.first("n_shingles").alias("n_shingles"), F.first("items").alias("items"), F.first("profile").alias("profile"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("cid").alias("a"), F.col("n_shingles").alias("na"), F.col("items").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("n_shingles").alias("nb"), F.col("items").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    def confirm(batches):
        for batch in _small(batches, 500):
            a, b, x, y = (batch.column(i) for i in range(4))
            ok = []
            for p, q in zip(x, y):
                u, v = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                if len(u) > len(v):
                    u, v = v, u
                at = np.searchsorted(v, u)
                common = int((v[np.minimum(at, len(v) - 1)] == u).sum())
                ok.append(100 * common >= percent * (len(u) + len(v) - common))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(ok), b.filter(ok)], ["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(tidy(confirm), "a long, b long")


def _open_pairs(prefix: DataFrame, profiles: DataFrame, comps: DataFrame, percent: int, *, best: bool) -> DataFrame:
    """Pairs (a, b) of different components that share a list and agree enough, each formed at the first list they share.

    ``best``: of each class in a list only the pair that agrees most.
    """
    marked = prefix.join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    spread = marked.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).filter("lo < hi").select("key", F.expr(f"int(ceil(n / {BLOCK}))").alias("blocks"))
    opened = marked.join(spread, "key")
    # Block pairs: a class goes to each pair that its own block is part of.
    own = F.expr("int(pmod(xxhash64(cid, key), blocks))")
    dealt = opened.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "comp", "coord", "mask")
    ready = dealt.join(profiles.select("cid", "n_shingles", "profile"), "cid").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(i, j, coord, own, cid, comp, n, mask, sig, extra):
        left, right = np.nonzero(own == i)[0], np.nonzero(own == j)[0]
        found = []
        # Coordinates before this list's, in which an agreement of two prefixes forms the pair elsewhere.
        earlier = np.int64((1 << int(coord)) - 1)
        bits = (mask[:, None] >> np.arange(int(coord))) & 1 == 1
        for r in left:
            others = right[(comp[right] != comp[r]) & (100 * np.minimum(n[right], n[r]) >= percent * np.maximum(n[right], n[r]))]
            if i == j:
                others = others[others > r]
            if not len(others):
                continue
            same = sig[others] == sig[r]
            ok = same.sum(axis=1) >= MATCHES
            if mask[r] & earlier:
                ok &= ~(same[:, : len(bits[r])] & bits[others] & bits[r]).any(axis=1)
            others = others[ok]
            if not len(others):
                continue
            agree = _agreeing(extra[others], extra[r])
            others, agree = others[agree >= AGREE], agree[agree >= AGREE]
            if best and len(others):
                others = others[[agree.argmax()]]
            found += [(min(cid[r], cid[o]), max(cid[r], cid[o])) for o in others.tolist()]
        return found

    def walk(batches):
        held = []

        def close():
            t = pa.Table.from_batches(held)
            held.clear()
            col = {c: t.column(c).to_numpy() for c in ("own", "cid", "comp", "n_shingles", "mask")}
            sig, extra = _profiles(t.column("profile").to_pylist())
            pairs = compare(t.column("i")[0].as_py(), t.column("j")[0].as_py(), t.column("coord")[0].as_py(), col["own"], col["cid"], col["comp"], col["n_shingles"], col["mask"], sig, extra)
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        last = None
        for batch in batches:
            marks = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j"))))
            lo = 0
            for at in range(1, len(marks) + 1):
                if at == len(marks) or marks[at] != marks[lo]:
                    if held and marks[lo] != last:
                        yield close()
                    held.append(batch.slice(lo, at - lo))
                    last, lo = marks[lo], at
        if held:
            yield close()

    return ready.mapInArrow(tidy(walk), "a long, b long").distinct()


#: Nodes whose neighbours are dealt evenly instead of to one task: those with more than HEAVY_LEAST of them and more
#: than one in HEAVY_NODES of all, so that there are fewer than HEAVY_NODES and they may be broadcast.
HEAVY_NODES = 10_000
HEAVY_LEAST = 256


def _with_least(edges: DataFrame, key: str, stats: DataFrame, n: int) -> DataFrame:
    """``edges``, at most ``n`` of them, with the ``m`` that ``stats`` (node, m, rows) has for ``key``.

    Rows of a heavy node get theirs by broadcast, and go through the join under negative keys, which no node has.
    """
    heavy = stats.filter(F.col("rows") > max(HEAVY_LEAST, n // HEAVY_NODES)).select(F.col("node").alias(key), F.col("m").alias("known"), F.lit(True).alias("heavy"))
    marked = edges.join(F.broadcast(heavy), key, "left")
    spread = F.when(F.col("heavy"), -1 - F.shiftrightunsigned(F.xxhash64("u", "v"), 1)).otherwise(F.col(key))
    return marked.withColumn("node", spread).join(stats.select("node", "m"), "node", "left").select("u", "v", F.coalesce("known", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node in ``links`` (a, b): comp is the smallest node reachable.

    Alternating large-star and small-star contraction; every round is staged, and
    the driver gives back what its plans took.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    mark, n = None, links.count()
    while True:
        # Large star: larger neighbours of a node go to the smallest of its neighbourhood, itself included.
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("m"), F.lit(0).alias("one")).unionByName(edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("m"), F.lit(1).alias("one")))
        stats = ends.groupBy("node").agg(F.min("m").alias("m"), F.sum("one").alias("rows"))
        large = _with_least(edges, "v", stats, n).select("u", F.coalesce("m", "v").alias("v")).distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        stats = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"), F.count("*").alias("rows"))
        small = _with_least(large, "u", stats, n)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        edges = stage(small, "links")
        shrink_driver(links.sparkSession)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark, n = now, now[0]
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("comp"))


def _judged(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, th, n_shingles, node, comp (null without shingles), component_id of every row of ``docs``."""
    if percent < PERCENT:
        raise ValueError(f"percent must be at least {PERCENT}")
    signed = stage(document_signatures(docs, size), "signatures")
    # A class is known by its first row, rows without a doc_id last: its set is built from that row's text.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first")
    alike = signed.filter("node is not null").groupBy("node").agg(first, F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"))
    classes = stage(alike.withColumn("cid", F.monotonically_increasing_id()), "classes")
    prefix = stage(_prefixes(classes), "prefixes")
    wanted = stage(classes.select("cid", "node", "first").join(prefix.select("cid").distinct(), "cid", "left_semi"), "wanted")
    sets = stage(_sets(docs, wanted, size), "sets")
    links = stage(_confirm(_first_pairs(prefix, sets), sets, percent), "links")
    comps = components(links)
    for best in (True, False):
        pairs = stage(_open_pairs(prefix, sets, comps, percent, best=best), "pairs")
        links = stage(links.unionByName(_confirm(pairs, sets, percent)), "links")
        comps = components(links)
    member = classes.select("node", "cid", "first").join(comps.withColumnRenamed("node", "cid"), "cid", "left").select("node", "first", F.coalesce("comp", "cid").alias("comp"))
    smallest = member.groupBy("comp").agg(F.min("first").alias("least"))
    labels = member.join(smallest, "comp").select("node", "comp", "least")
    out = signed.select("doc_id", "th", "n_shingles", "node").join(labels, "node", "left")
    return out.select("doc_id", "th", "n_shingles", "node", "comp", "least", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Null or empty texts have no shingles and link with nothing.  Rows with one
    doc_id, or with none, are judged each on its own text; a component's id is
    the smallest doc_id in it, null if no member has one.  ``percent`` must be
    80 or more: the signature bounds hold from there.
    """
    out = _judged(docs, size, percent).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, *, size: int, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with their columns, less all but one of each component.

    The one that stays has the smallest doc_id of the component, and of rows with
    that doc_id one with the smallest text hash; of rows alike in both, any one.
    Rows without shingles all stay.
    """
    mine = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    judged = _judged(docs, size, percent).filter("node is not null")
    fate = judged.groupBy("doc_id", "th").agg(F.first(mine == F.col("least")).alias("stays"), F.count("*").alias("n"))
    fate = stage(fate.filter("not stays or n > 1").select(F.col("doc_id").alias("of"), F.col("th").alias("its"), F.coalesce("stays", F.lit(False)).alias("stays")), "fates")
    keyed = docs.select("*", F.xxhash64("text").alias("__th"), F.col("doc_id").cast("long").alias("__id"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("__th") == F.col("its"))
    # Only rows that pass the sieve may have a fate, and are joined with theirs.
    through = _sieve(fate, ["of", "its"])
    some = through(keyed, ["__id", "__th"], "left_semi")
    single = through(keyed, ["__id", "__th"], "left_anti").unionByName(some.join(maybe_broadcast(fate.drop("stays")), same, "left_anti"))
    # Rows alike in doc_id and text, of which one stays.
    several = some.join(maybe_broadcast(fate.filter("stays")), same, "left_semi")
    one = several.groupBy("doc_id", "__th").agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*")
    return single.select(*docs.columns).unionByName(one)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
