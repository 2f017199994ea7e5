"""Quality rules with risk-controlled thresholds, in DataFrame and SQL functions only.

Every rule is ``statistic > cutoff: reject``.  The cutoffs are not set by hand:
a level of strictness gives every rule its cutoff, so the levels are policies
that each reject all that the laxer ones do.  Labelled documents are a holdout
on which, per stratum (language) and level, the good documents that the policy
rejects beyond the base rules are counted.  A level is certified if it and all
laxer ones pass the exact binomial test of "the policy rejects more than a share
RISK of good documents", at CONFIDENCE shared out over the strata that have
enough good labels to certify anything.  Testing from lax to strict and stopping
at the first failure needs no further correction for the number of levels.  So
with probability 1 - CONFIDENCE the learned rules reject at most a share RISK of
good documents in any stratum.  Of the certified levels the one that rejects
most labelled low-quality documents, less the good ones it rejects, is chosen;
the laxest of equals.  A stratum with too few labels certifies nothing and
rejects nothing by this method.
"""

from __future__ import annotations

import math

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from .common import maybe_broadcast, stage, table

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
#: Largest share of a stratum's good documents that all learned rules together may reject.
RISK = 0.02
#: Probability that the certified level of any stratum breaks RISK.
CONFIDENCE = 0.05
#: Rules: two statistics of a document, and at each level, lax to strict, how much of the second the first may be.
RULES = {
    "symbols": ("n_symbols", "n_words", (1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1)),
    "repeats": ("n_repeat_words", "n_words", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25)),
    "shouts": ("n_shouts", "n_words", (0.9, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "duplicate_lines": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
}


def _let(value: Column, body) -> Column:
    """``body`` of ``value`` computed once: a lambda's variable is evaluated before its body."""
    return F.transform(F.array(value), body).getItem(0)


def split_column(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words covered by a 3-word window that occurs twice or more among ``words``.

    Windows are compared by 64-bit hash within one document.
    """
    three = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(starts: Column) -> Column:
        # Each start covers three words, fewer if the next start comes sooner.
        steps = F.transform(F.sequence(F.lit(1), F.size(starts) - 1), lambda k: F.least(F.lit(3), F.get(starts, k) - F.get(starts, k - 1)))
        return F.aggregate(steps, F.lit(3), lambda s, x: s + x)

    def marked(order: Column) -> Column:
        same = lambda k, j: F.get(order, k)["h"] == F.get(order, j)["h"]
        twice = F.filter(F.sequence(F.lit(0), F.size(order) - 1), lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)))
        return _let(F.sort_array(F.transform(twice, lambda k: F.get(order, k)["i"])), covered)

    def counted(hashes: Column) -> Column:
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(order, marked))

    return F.when(F.size(words) < 4, 0).otherwise(_let(three, counted)).cast("long")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``q`` of the document's statistics; null text has no words."""
    body = F.coalesce(F.col(text), F.lit(""))
    count = lambda chars: F.length(body) - F.length(F.translate(body, chars, ""))

    def of_words(words: Column) -> Column:
        shouts = F.size(F.filter(words, lambda w: F.endswith(w, F.lit("!")) & (w == F.upper(w))))
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeat_words(words).alias("n_repeat_words"), shouts.cast("long").alias("n_shouts"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(body, "\n"), lambda line: F.translate(line, " \t\n\x0b\x0c\r", "") != "")
    by_word, by_line = _let(split_column(body), of_words), _let(lines, of_lines)
    chars = F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long")
    made = docs.select("*", by_word.alias("__w"), by_line.alias("__l"), chars.alias("__c"), count("#*$%&|<>").cast("long").alias("__s"))
    q = F.struct(
        F.col("__w.n_words"), F.col("__c").alias("word_chars"), F.col("__s").alias("n_symbols"), F.col("__l.n_dup_lines"), F.col("__w.n_repeat_words"), F.col("__w.n_shouts"), F.col("__l.n_lines")
    )
    return made.select(*docs.columns, q.alias("q"))


LEVELS = range(1, 1 + max(len(cutoffs) for *_, cutoffs in RULES.values()))
BASE = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"


def policy(level: int) -> str:
    """SQL: whether any rule rejects at the level."""
    return "(" + " OR ".join(f"CAST({part} AS DOUBLE) / greatest({whole}, 1) > {cutoffs[level - 1]!r}e0" for part, whole, cutoffs in RULES.values()) + ")"


def least_labels(risk: float, confidence: float) -> int:
    """Good labels below which nothing can be certified, whatever they show."""
    return math.ceil(math.log(confidence) / math.log1p(-risk))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of Bin(n, p), exact up to rounding: the p-value of "the risk is p or more" after k events in n."""
    first = n * math.log1p(-p)
    ratio = math.log(p) - math.log1p(-p)

    def add(acc, j):
        term = acc["t"] + F.log((n - j + 1) / j) + F.lit(ratio)
        return F.struct(term.alias("t"), (acc["s"] + F.exp(term)).alias("s"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(terms, F.struct(first.alias("t"), F.exp(first).alias("s")), add, lambda acc: acc["s"])
    # Above its mean the tail is over one half or so: never certified, and not worth its terms.
    return F.when(n == 0, 1.0).when(k > n * p, 1.0).otherwise(tail)


def certified_levels(judged: DataFrame, labels: DataFrame, *, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """(stratum, level) of the strata that certify one, from ``judged`` (doc_id, stratum, statistics) and ``labels``.

    A document's label is the lowest quality given to it; null ones do not count.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    seen = judged.join(known, "doc_id")
    good, poor, left = F.col("quality") >= 1, F.col("quality") < 1, ~F.expr(BASE)
    aggs = [F.count_if(good).alias("n")]
    for level in LEVELS:
        out = F.expr(policy(level)) & left
        aggs += [F.count_if(out & good).alias(f"g{level}"), F.count_if(out & poor).alias(f"p{level}")]
    wide = seen.groupBy("stratum").agg(*aggs).filter(F.col("n") >= least_labels(risk, confidence))
    strata = wide.agg(F.count("*").alias("strata"))  # one row
    rows = F.array(*[F.struct(F.lit(level).alias("level"), F.col(f"g{level}").alias("k"), F.col(f"p{level}").alias("hits")) for level in LEVELS])
    long = wide.crossJoin(F.broadcast(strata)).select("stratum", "n", "strata", F.explode(rows).alias("c")).select("stratum", "n", "strata", "c.*")
    # Stricter levels reject more, so the levels that pass are the first ones.
    passed = long.filter(binomial_tail(F.col("k"), F.col("n"), risk) * F.col("strata") <= confidence).filter("hits > k")
    return passed.groupBy("stratum").agg(F.max_by("level", F.struct((F.col("hits") - F.col("k")).alias("gain"), -F.col("level"))).alias("level"))


def _verdict(judged: DataFrame, levels: DataFrame) -> DataFrame:
    """``judged`` with base_failed and kept."""
    marked = judged.join(maybe_broadcast(levels), "stratum", "left")
    rejected = F.lit(False)
    for level in LEVELS:
        rejected = F.when(F.col("level") == level, F.expr(policy(level))).otherwise(rejected)
    base = F.expr(BASE)
    return marked.withColumn("base_failed", base).withColumn("kept", ~base & ~rejected)


def judge(docs: DataFrame, labels: DataFrame, *, risk: float = RISK) -> DataFrame:
    """Statistics and verdict of every row; repeated rows are judged alike, a null language is a stratum of its own."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("stratum"))
    judged = stage(statistics(slim).select("doc_id", "stratum", "q.*"), "quality")
    levels = stage(certified_levels(judged, labels, risk=risk), "levels")
    return _verdict(judged, levels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def kept_documents(docs: DataFrame, labels: DataFrame, *, risk: float = RISK) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    columns = docs.columns
    packed = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("stratum"))
    made = stage(statistics(packed).select("row", "doc_id", "stratum", "q.*"), "quality")
    levels = stage(certified_levels(made.drop("row"), labels, risk=risk), "levels")
    return _verdict(made, levels).filter("kept").select("row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_LEVELS_SQL = " UNION ALL ".join(f"SELECT stratum, quality, {level} AS level, {policy(level)} AND NOT {BASE} AS hit FROM seen" for level in LEVELS)
OP3_SQL = f"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g') <> '') AS lines
  FROM documents),
pos AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM split),
wins AS (SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS t FROM pos),
dups AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM wins) WHERE n > 1),
reps AS (SELECT doc_id, count(DISTINCT i + o.d) AS n_repeat_words FROM dups, (SELECT unnest([0, 1, 2]) AS d) o GROUP BY doc_id),
q AS (
  SELECT s.doc_id, s.stratum, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: ends_with(x, '!') AND x = upper(x)))::BIGINT AS n_shouts
  FROM split s LEFT JOIN reps r ON s.doc_id = r.doc_id),
seen AS (SELECT q.*, l.quality FROM q JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l ON q.doc_id = l.doc_id),
cells AS ({_LEVELS_SQL}),
counts AS (
  SELECT stratum, level, count(*) FILTER (quality >= 1) AS n, count(*) FILTER (quality >= 1 AND hit) AS k, count(*) FILTER (quality < 1 AND hit) AS hits
  FROM cells GROUP BY stratum, level),
able AS (SELECT *, (SELECT count(DISTINCT stratum) FROM counts WHERE n >= {least_labels(RISK, CONFIDENCE)}) AS strata FROM counts WHERE n >= {least_labels(RISK, CONFIDENCE)}),
passed AS (
  SELECT *, list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK!r}) + (n - j) * ln(1 - {RISK!r})))) AS p
  FROM able WHERE k <= n * {RISK!r} AND hits > k),
chosen AS (SELECT stratum, arg_max(level, (hits - k) * 1000.0 - level) AS level FROM passed WHERE p * strata <= {CONFIDENCE!r} GROUP BY stratum),
base AS (SELECT *, {BASE} AS base_failed FROM q)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(CASE level {" ".join(f"WHEN {level} THEN {policy(level)}" for level in LEVELS)} END, false) AS kept
FROM base b LEFT JOIN chosen c ON b.stratum = c.stratum
"""
