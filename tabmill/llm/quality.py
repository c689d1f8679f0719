"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (words and runs of punctuation, sizes 1 and 2; a bigram of one word
twice also counts in a bucket of its own) are counted:
the target model from documents labelled good, the raw model from all documents.  The log importance weight of
a document is the prior log odds of good among the labels plus the sum over its n-grams of log(target / raw) less ``bar``, where
``bar`` is the value per n-gram that best separates labelled good from bad documents.  Documents are then drawn without replacement, in proportion to
their importance, by Gumbel top-k: log weight plus keyed standard Gumbel noise, the k largest stay.  The caller gives the sample size k; without
one, k is the number of documents whose weight is not negative, the size of the set that the ratio alone accepts.

Only sums per hash bucket, histogram counts and the bounded labelled sample reach the driver.

Defined cases: null and empty texts have no n-grams, hence the prior as their weight; repeated rows have equal
weight and noise and are kept or rejected together; ids may be null (their noise is keyed by null); without labelled good
documents every ratio is 0; without bad ones the bar is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import labelled_sample, with_fields, written

BUCKETS = 1 << 16
TARGET_ROWS = 6000  # labelled documents used at most
SMOOTH = 1.0
GOOD_COST = 4.0
SEED = 11


def _ngrams(column):
    """(first row, texts, bucket of every n-gram, its text index) per slice."""
    for first, data, at in tv.slices(column):
        words = tv.Words(data, at, lower=False, kind=tv.PUNCT)
        h1, d1 = words.shingles(1)
        h2, d2 = words.shingles(2, short=False)
        again = np.flatnonzero((words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1]))
        bucket = (np.concatenate((h1, h2)) % np.uint64(BUCKETS - 1)).astype(np.int64)
        yield (first, words.n, np.concatenate((bucket, np.full(len(again), BUCKETS - 1))),
               np.concatenate((d1, d2, words.doc[again])))


def bucket_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """N-gram count per bucket over all of ``docs``: one vector per task, summed by bucket."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, bucket, _ in _ngrams(batch.column(0)):
                total += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(BUCKETS)
    for r in rows:
        out[r.bucket] = r.n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    return (np.log((target + SMOOTH) / (target.sum() + SMOOTH * BUCKETS))
            - np.log((raw + SMOOTH) / (raw.sum() + SMOOTH * BUCKETS)))


def weigh(docs: DataFrame, ratio: np.ndarray, bar: float = 0.0, prior: float = 0.0, text_col: str = "text", weight_col: str = "log_weight",
          count_col: str = "n_grams") -> DataFrame:
    """``docs`` with its log importance weight and number of n-grams appended (replacing columns of these names)."""
    base = docs.select(*[c for c in docs.columns if c not in (weight_col, count_col)])
    at = base.columns.index(text_col)

    def run(batches):
        for batch in batches:
            weight, count = np.full(batch.num_rows, prior), np.zeros(batch.num_rows, np.int64)
            for first, n, bucket, doc in _ngrams(batch.column(at)):
                weight[first:first + n] += np.bincount(doc, weights=ratio[bucket] - bar, minlength=n)
                count[first:first + n] = np.bincount(doc, minlength=n)
            yield pa.record_batch([*batch.columns, pa.array(np.round(weight, 6)), pa.array(count)],
                                  names=[*batch.schema.names, weight_col, count_col])

    return base.mapInArrow(run, with_fields(base, **{weight_col: T.DoubleType(), count_col: T.LongType()}))


def best_bar(mean: np.ndarray, good: np.ndarray) -> float:
    """Value between two neighbouring means that best separates good (above) from bad; of the two errors, losing a
    good text weighs ``GOOD_COST`` times as much."""
    if not good.any() or good.all():
        return 0.0
    order = np.argsort(mean, kind="stable")
    mean, good = mean[order], good[order]
    gain = np.cumsum(~good) / (~good).sum() - GOOD_COST * np.cumsum(good) / good.sum()
    gain[:-1][mean[1:] == mean[:-1]] = -np.inf  # equal means cannot be parted
    i = int(np.argmax(gain))
    return float((mean[i] + mean[min(i + 1, len(mean) - 1)]) / 2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
        rows: int = TARGET_ROWS) -> tuple[np.ndarray, float, float]:
    """(log ratio per bucket, bar, prior log odds of good): the raw model counts all documents, the target model a bounded labelled sample."""
    sample = written(labelled_sample(docs.select(id_col, F.col(text_col).alias("text")), labels, label, rows, id_col)
                     .select("text", "label"), "quality-sample")
    ratio = log_ratio(bucket_counts(sample.where("label = 1")), bucket_counts(docs, text_col))
    means = weigh(sample, ratio).where("n_grams > 0").select((F.col("log_weight") / F.col("n_grams")).alias("m"), "label").collect()
    good = np.array([r.label == 1 for r in means], bool)
    bar = best_bar(np.array([r.m for r in means]), good)
    return ratio, bar, float(np.log((good.sum() + SMOOTH) / ((~good).sum() + SMOOTH)))


def gumbel(id_col: str, seed: int = SEED):
    """Keyed standard Gumbel noise: the uniform number is a hash of (id, seed)."""
    u = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th largest value of column ``key`` (-inf if there are fewer, +inf for k = 0) by refining histograms:
    each round counts values per bin and descends into the bin that holds the k-th."""
    if k <= 0:
        return float("inf")
    edge = keys.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("key").alias("n")).first()
    if edge.n < k:
        return float("-inf")
    lo, hi = edge.lo, edge.hi
    while True:
        inside = keys.where((F.col("key") >= lo) & (F.col("key") <= hi))
        width = (hi - lo) / bins
        if width <= 0 or lo + width <= lo:
            return lo
        bin_of = F.least(F.floor((F.col("key") - lo) / width), F.lit(bins - 1))
        counts = (inside.groupBy(bin_of.alias("bin"))
                  .agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect())
        for r in sorted(counts, key=lambda r: -r.bin):
            if k <= r.n:
                break
            k -= r.n
        if r.lo == r.hi or k == r.n:
            return r.lo
        lo, hi = r.lo, r.hi


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None,
             seed: int = SEED) -> DataFrame:
    """``docs`` with ``log_weight``, ``n_grams`` and ``kept`` appended: a draw of ``k`` documents by importance (documents
    with the same key as the k-th stay too; all stay if there are fewer)."""
    ratio, bar, prior = fit(docs, labels, id_col, text_col)
    weighed = weigh(docs, ratio, bar, prior, text_col)
    key = F.col("log_weight") + gumbel(id_col, seed)
    keys = written(weighed.select("log_weight", key.alias("key")), "quality-keys")
    k = keys.where("log_weight >= 0").count() if k is None else k
    return weighed.withColumn("kept", key >= F.lit(kth_largest(keys, k)))
