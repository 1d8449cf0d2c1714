"""Quality rules: hashed n-gram log-likelihood ratio against the raw corpus.

Every document is a bag of hashed word uni- and bigrams.  Two multinomials
over the hash buckets are counted: the *target* over trusted documents
(label quality 1, not toxic) and the *raw* one over the whole corpus.  A
document's score is the mean of ``ln p_target - ln p_raw`` over its n-grams
(length-normalised), held in whole micro-nats so that the sum does not
depend on the order of addition.  A document is kept when it passes the base
rules and its score reaches the threshold.

Everything runs as DataFrame expressions; no Python sees a row.  The raw
counts cover every document.  The trusted counts and the threshold are fitted
on at most ``sample_rows`` labelled documents (a documented bound, taken in
hash order of doc_id), so what is broadcast or collected is bounded: the
sample's ids, ``buckets`` counts and one threshold.

Defined cases: a null or empty text has no words and fails the base rule;
without trusted documents every weight is 0 and only the base rules decide;
without rejected labels the threshold falls back to the trusted scores'
floor; repeated rows are scored row by row; other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, forget, fresh, materialise, whole_text

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30


@dataclass(frozen=True)
class Model:
    """Bucket weights in micro-nats and the threshold on the mean weight."""

    weights: tuple
    threshold: float

    @property
    def buckets(self) -> int:
        return len(self.weights)


def _let(value: Column, body) -> Column:
    """Bind a value once for several uses inside one row expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def bucket_array(words: Column, buckets: int) -> Column:
    """Hash buckets of the word unigrams and bigrams (the last word pairs with a line end,
    which no word contains).  ``buckets`` is a power of two."""
    mask = F.lit(buckets - 1)
    one = F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(mask).cast("int"))
    two = F.transform(words, lambda w, i: F.xxhash64(w, F.coalesce(F.get(words, i + 1), F.lit("\n")))
                      .bitwiseAND(mask).cast("int"))
    return F.concat(one, two)


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside any 8-word window that occurs twice or more in the row."""

    def covered(starts: Column) -> Column:
        # windows overlap: each start adds the words up to the next start, 8 at most
        return F.aggregate(starts, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
                           lambda acc, p: F.struct(p.alias("last"), (acc["sum"] + F.least(p - acc["last"], F.lit(WINDOW))).alias("sum")),
                           lambda acc: acc["sum"])

    def repeated(keyed: Column) -> Column:
        """Positions whose window hash equals a neighbour's in (hash, position) order."""
        same = lambda e, j: (F.get(keyed, j - 1)["h"] == e["h"]) | (F.get(keyed, j + 1)["h"] == e["h"])
        hits = F.filter(keyed, lambda e, j: F.coalesce(same(e, j), (F.get(keyed, j - 1)["h"] == e["h"]),
                                                       (F.get(keyed, j + 1)["h"] == e["h"]), F.lit(False)))
        return F.sort_array(F.transform(hits, lambda e: e["i"]))

    def count(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _let(keyed, lambda k: covered(repeated(k))))

    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return F.when(n < WINDOW, F.lit(0)).otherwise(_let(hashes, count))


def base_columns(text: Column, words: Column) -> Column:
    """The contract's counts of one row as a struct."""
    n = F.size(words)
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(WORD)))
    return _let(n, lambda n: F.struct(
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long")).alias("n_dup_lines"),
        _repeat_words(words, n).cast("long").alias("n_repeat_words")))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat * 100 > n_words * MAX_REPEAT_PCT)


def _mean_weight(words: Column, weights: Column, buckets: int) -> Column:
    """Mean weight in nats of the row's n-grams; null without words."""
    total = F.aggregate(bucket_array(words, buckets), F.lit(0).cast("long"), lambda acc, b: acc + F.get(weights, b))
    return F.try_divide(total.cast("double"), (F.size(words) * 2).cast("double")) / F.lit(1e6)


def _weights_literal(model: Model) -> Column:
    return F.split(F.lit(",".join(map(str, model.weights))), ",").cast("array<bigint>")


def bucket_counts(docs: DataFrame, text_col: str, buckets: int) -> dict:
    """Occurrences by bucket over all rows: partial sums per task, at most ``buckets`` rows shuffled by each."""
    rows = (docs.select(F.explode(_let(words_of(whole_text(text_col)), lambda w: bucket_array(w, buckets))).alias("b"))
            .groupBy("b").count().collect())
    return {r["b"]: r["count"] for r in rows}


def llr_weights(target: dict, raw: dict, buckets: int, alpha: float = 1.0) -> tuple:
    """ln p_target - ln p_raw per bucket with add-alpha smoothing, in whole micro-nats."""
    if not target:
        return (0,) * buckets
    n_t, n_r = sum(target.values()) + alpha * buckets, sum(raw.values()) + alpha * buckets
    return tuple(round(1e6 * (math.log((target.get(b, 0) + alpha) / n_t) - math.log((raw.get(b, 0) + alpha) / n_r)))
                 for b in range(buckets))


def pick_threshold(scored: list, keep_share: float) -> float:
    """The cut that separates the labelled scores best (largest sum of the trusted share kept and
    the rejected share dropped), never above the value that keeps ``keep_share`` of the trusted;
    it lies halfway to the next lower labelled score, so that unlabelled good rows have a margin."""
    good = sorted(s for s, q in scored if q == 1)
    bad = sorted(s for s, q in scored if q == 0)
    if not good:
        return -math.inf
    floor = good[min(len(good) - 1, int((1 - keep_share) * len(good)))]
    if not bad:
        return floor
    best, cut, g, b, below = -1.0, floor, 0, 0, None
    for s in sorted(set(good + bad)):
        if s > floor:
            break
        while g < len(good) and good[g] < s:
            g += 1
        while b < len(bad) and bad[b] < s:
            b += 1
        gain = b / len(bad) - g / len(good)
        if gain > best:
            best, cut = gain, s if below is None else (s + below) / 2
        below = s
    return cut


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", buckets: int = 1 << 13,
        sample_rows: int = 20_000, keep_share: float = 0.995) -> Model:
    """Weights and threshold.  ``sample_rows`` bounds the labelled rows used to fit; the raw counts use every row."""
    ids = (labels.select(F.col(id_col).cast("long").alias("id"), F.col("quality").cast("int").alias("quality"),
                         F.coalesce(F.col("toxic").cast("int"), F.lit(0)).alias("toxic"))
           .where("id is not null and quality is not null")
           .groupBy("id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    sample = materialise(
        docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
        .join(F.broadcast(ids), "id"), "quality-sample")
    # one half of the sample counts the target, the other half, unseen by it, sets the threshold
    held_out = F.expr("xxhash64(id, 1) & 1") == 1
    target = bucket_counts(sample.where(~held_out & F.expr("quality = 1 and toxic = 0")), "text", buckets)
    weights = llr_weights(target, bucket_counts(docs, text_col, buckets), buckets)
    model = Model(weights, -math.inf)
    scored = (sample.where(held_out & F.expr("toxic = 0")).select("quality", _let(words_of(F.col("text")), lambda w: F.struct(
        _mean_weight(w, _weights_literal(model), buckets).alias("s"), base_columns(F.col("text"), w).alias("b"))).alias("x"))
        .where(~base_failed(F.col("x.b.n_words"), F.col("x.b.n_repeat_words")))
        .select(F.col("x.s").alias("s"), "quality").collect())
    forget(docs.sparkSession, sample)
    return Model(weights, pick_threshold([(r["s"], r["quality"]) for r in scored], keep_share))


def assess(docs: DataFrame, model: Model, text_col: str = "text", out: str = "quality") -> DataFrame:
    """All columns plus the struct ``out``: the base counts, ``base_failed``, ``score`` and ``kept``."""
    text = whole_text(text_col)
    row = _let(text, lambda t: _let(words_of(t), lambda w: F.struct(
        base_columns(t, w).alias("b"), _mean_weight(w, _weights_literal(model), model.buckets).alias("score"))))
    raw = fresh(docs, "__quality")
    df = docs.withColumn(raw, row)
    b = F.col(f"{raw}.b")
    failed = base_failed(b["n_words"], b["n_repeat_words"])
    return df.withColumn(out, F.struct(
        *[b[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"), F.col(f"{raw}.score").alias("score"),
        (~failed & (F.col(f"{raw}.score") >= F.lit(model.threshold))).alias("kept"))).drop(raw)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline form: the rows that pass, with the columns of ``docs``."""
    out = fresh(docs, "__verdict")
    return assess(docs, fit(docs, labels), out=out).where(F.col(f"{out}.kept")).select(*[docs[c] for c in docs.columns])
