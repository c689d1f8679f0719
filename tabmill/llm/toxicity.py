"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

P(grade <= j) = sigmoid(threshold_j - w.x): one weight vector shared by all ordered thresholds.  x marks which words and
word stems of a learned vocabulary a text has.  The vocabulary (at most ``WORDS`` entries) holds those most associated with the grades
in a bounded labelled sample; features are exact hashes, so words outside it never count.  The result per document is the expected severity
sum_j j * P(grade = j), the probability of any toxicity, the most probable grade, and ``toxic``: whether the probability
reaches the cut, which the clean texts of the sample set (0.5 at most).

Defined cases: null, empty and wordless texts have no features and get the base rate; repeated rows score alike; a tie between grades
goes to the lower; labels without any toxic (or any clean) row give severity 0 everywhere; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import labelled_sample, with_fields, written

ROWS = 8000  # labelled documents used at most
WORDS = 2048  # features at most
STEMS = (3, 4, 5, 6)  # bytes
MIN_SHARE = 0.01  # share of the toxic sample texts, as a count, in which a feature must occur at least
PENALTY = 2e-4
CLEAN_ABOVE = 0.001  # share of clean sample texts that may score above the cut for ``toxic``


def _marks(words: tv.Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word and of its stems (its first ``STEMS`` bytes, where it is longer)."""
    hashes, docs = [words.hash], [words.doc]
    for k in STEMS:
        longer = np.flatnonzero(words.end - words.start > k)
        hashes.append(tv.mix(words.prefix_hash(longer, k) + np.uint64(k)))
        docs.append(words.doc[longer])
    return np.concatenate(hashes), np.concatenate(docs)


def _distinct_marks(column):
    """(row, sorted distinct feature hashes) of every text."""
    for first, data, at in tv.slices(pc.utf8_lower(column)):
        words = tv.Words(data, at, lower=False, kind=tv.PUNCT)
        h, doc = _marks(words)
        order = np.argsort(doc, kind="stable")
        for i, part in enumerate(tv.per_text(h[order], doc[order], words.n)):
            yield first + i, np.unique(part)


def _known_marks(column, known: np.ndarray):
    """(row, sorted distinct indices into the sorted hashes ``known``) of every text that has any."""
    for first, data, at in tv.slices(pc.utf8_lower(column)):
        h, doc = _marks(tv.Words(data, at, lower=False, kind=tv.PUNCT))
        if not len(known):
            continue
        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = known[place] == h
        pairs = np.unique(doc[hit] * len(known) + place[hit])
        doc, place = pairs // len(known), pairs % len(known)
        cut = np.flatnonzero(np.diff(doc)) + 1
        for d, part in zip(np.split(doc, cut), np.split(place, cut)):
            if len(d):
                yield first + int(d[0]), part


def vocabulary(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, toxic share) of the words whose presence is most associated with a positive label."""

    def run(batches):
        words, toxic = [], []
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False) > 0
            for row, w in _distinct_marks(batch.column(0)):
                words.append(w)
                toxic.append(np.full(len(w), label[row]))
        if words:
            v, at = np.unique(np.concatenate(words), return_inverse=True)
            yield pa.record_batch([pa.array(tv.signed(v)), pa.array(np.bincount(at, minlength=len(v))),
                                   pa.array(np.bincount(at, weights=np.concatenate(toxic), minlength=len(v)).astype(np.int64))],
                                  names=["word", "n", "toxic"])

    total = sample.agg(F.count("*").alias("n"), F.sum((F.col("label") > 0).cast("long")).alias("toxic")).first()
    if not total.n or not total.toxic or total.toxic == total.n:
        return np.zeros(0, np.uint64), np.zeros(0)
    rate = total.toxic / total.n
    z = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    rows = (sample.select("text", F.col("label").cast("int")).mapInArrow(run, "word long, n long, toxic long")
            .groupBy("word").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
            .where(F.col("n") >= max(2, MIN_SHARE * total.toxic)).withColumn("z", F.round(F.abs(z), 9)).orderBy(F.desc("z"), "word").limit(WORDS).collect())
    words = np.array([r.word for r in rows], np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], np.array([r.toxic / r.n for r in rows])[order]


def features(docs: DataFrame, words: np.ndarray, text_col: str = "text", out_col: str = "present") -> DataFrame:
    """``docs`` with the indices of the vocabulary words that each text has."""
    base = docs.select(*[c for c in docs.columns if c != out_col])
    at = base.columns.index(text_col)

    def run(batches):
        for batch in batches:
            got = [np.zeros(0, np.int64)] * batch.num_rows
            for row, part in _known_marks(batch.column(at), words):
                got[row] = part
            yield pa.record_batch([*batch.columns, pa.array(got, pa.list_(pa.int64()))], names=[*batch.schema.names, out_col])

    return base.mapInArrow(run, with_fields(base, **{out_col: T.ArrayType(T.LongType())}))


def severity_grades(present: list, toxic: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Ordinal grades where labels are only 0/1: toxic texts are split at the median number of words that
    occur in toxic texts alone into 1 and 2."""
    marks = np.array([np.count_nonzero(share[p] >= 1.0) for p in present])
    grade = np.zeros(len(toxic), np.int64)
    if toxic.any():
        grade[toxic] = 1 + (marks[toxic] > np.median(marks[toxic]))
    return grade


def fit_ordinal(present: list, grade: np.ndarray, n_features: int, rounds: int = 400, penalty: float = PENALTY):
    """(weights, thresholds) by proximal gradient steps with an L1 penalty on the weights.

    Thresholds are kept ordered as first value plus positive gaps.  The sample is bounded, so this runs on the driver."""
    k = int(grade.max()) + 1 if len(grade) else 1
    w = np.zeros(n_features)
    if k < 2:
        return w, np.zeros(0)
    row = np.repeat(np.arange(len(grade)), [len(p) for p in present])
    col = np.concatenate(present).astype(np.int64) if len(row) else np.zeros(0, np.int64)
    below = np.array([(grade <= j).mean() for j in range(k - 1)]).clip(1e-4, 1 - 1e-4)
    theta = np.maximum.accumulate(np.log(below / (1 - below)) + 1e-3 * np.arange(k - 1))
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    gw, gt = np.full(n_features, 1e-8), np.full(k - 1, 1e-8)
    n = len(grade)
    for _ in range(rounds):
        score = np.bincount(row, weights=w[col], minlength=n)
        c = np.concatenate((np.zeros((n, 1)), sigmoid(theta[None, :] - score[:, None]), np.ones((n, 1))), axis=1)
        p = np.maximum(c[np.arange(n), grade + 1] - c[np.arange(n), grade], 1e-9)
        slope = c * (1 - c)
        up, down = slope[np.arange(n), grade + 1] / p, slope[np.arange(n), grade] / p
        dw = np.bincount(col, weights=(up - down)[row], minlength=n_features) / n
        dt = np.array([-(up * (grade == j)).sum() + (down * (grade == j + 1)).sum() for j in range(k - 1)]) / n
        gw += dw * dw
        gt += dt * dt
        rate = 0.3 / np.sqrt(gw)
        w -= rate * dw
        w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
        theta = theta - 0.1 / np.sqrt(gt) * dt
        theta = np.maximum.accumulate(theta + 1e-9 * np.arange(k - 1))
    return w, theta


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
        rows: int = ROWS) -> dict:
    """Vocabulary, weights and thresholds from a bounded labelled sample (labels above 1 are taken as grades)."""
    sample = written(labelled_sample(docs.select(id_col, F.col(text_col).alias("text")), labels, label, rows, id_col)
                     .select("text", "label"), "toxicity-sample")
    words, share = vocabulary(sample)
    got = features(sample, words).select("label", "present").collect()
    present, given = [np.array(r.present, np.int64) for r in got], np.array([r.label for r in got], np.int64)
    grade = given if len(given) and given.max() > 1 else severity_grades(present, given > 0, share)
    w, theta = fit_ordinal(present, grade, len(words)) if len(words) else (np.zeros(0), np.zeros(0))
    used = np.flatnonzero(w)
    cut = 0.5
    if len(theta):
        p = np.array([1 - 1 / (1 + np.exp(w[x].sum() - theta[0])) for x, g in zip(present, grade) if g == 0])
        cut = min(0.5, max(0.2, 1.25 * float(np.quantile(p, 1 - CLEAN_ABOVE))))
    return {"words": words[used], "weights": w[used], "thresholds": theta, "cut": cut}


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``severity``, ``p_toxic``, ``grade`` and ``toxic`` appended (replacing columns of these names)."""
    added = ("severity", "p_toxic", "grade", "toxic")
    base = docs.select(*[c for c in docs.columns if c not in added])
    at = base.columns.index(text_col)

    def run(batches):
        words, w, theta = model["words"], model["weights"], model["thresholds"]
        for batch in batches:
            s = np.zeros(batch.num_rows)
            for row, part in _known_marks(batch.column(at), words):
                s[row] = w[part].sum()
            below = 1 / (1 + np.exp(-np.clip(theta[None, :] - s[:, None], -40, 40)))
            p = np.diff(np.concatenate((np.zeros((len(s), 1)), below, np.ones((len(s), 1))), axis=1), axis=1)
            yield pa.record_batch([*batch.columns, pa.array(np.round(p @ np.arange(p.shape[1]), 6)), pa.array(np.round(1 - p[:, 0], 6)),
                                   pa.array(np.argmax(p, axis=1).astype(np.int32)), pa.array(1 - p[:, 0] >= model["cut"])], names=[*batch.schema.names, *added])

    return base.mapInArrow(run, with_fields(base, severity=T.DoubleType(), p_toxic=T.DoubleType(), grade=T.IntegerType(),
                                              toxic=T.BooleanType()))
