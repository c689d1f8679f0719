"""Least squares from fold moments: one pass over the rows, then every fold model and every penalty from small matrices.

The design is an intercept, the numeric columns and a 0/1 column per level of the categorical ones.  One pass adds up the products of all pairs of design columns
and the target per fold (a matrix per task and fold moves, whatever the number of rows).  The training moments of fold k are
the total minus fold k's, so k models need no further pass, and neither do penalties: the squared error of any coefficients on any fold follows
from its moments.  Only the absolute percentage error needs the rows again, once for all models.

The matrices have a row per design column and live on the driver: a design of many thousand columns is not for this module.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Design:
    """Columns of the design, in order: intercept, ``numeric``, a 0/1 column per (column, level) of ``levels``; last the target."""

    numeric: list[str]
    levels: dict[str, list[str]]
    target: str

    @property
    def names(self) -> list[str]:
        return ["(intercept)", *self.numeric, *[f"{c}={v}" for c, lv in self.levels.items() for v in lv], self.target]

    def predict(self, coef: np.ndarray) -> Column:
        """Linear prediction as a built-in expression; a level outside the design adds nothing."""
        out, at = F.lit(float(coef[0])), 1
        for c in self.numeric:
            out, at = out + F.lit(float(coef[at])) * F.col(c), at + 1
        for c, lv in self.levels.items():
            if lv:
                found = F.create_map(*[x for v, b in zip(lv, coef[at:]) for x in (F.lit(v), F.lit(float(b)))])
                out = out + F.coalesce(F.try_element_at(found, F.col(c)), F.lit(0.0))
            at += len(lv)
        return out


def fold_gram(df: DataFrame, design: Design, fold_col: str = "fold") -> DataFrame:
    """``(fold, i, j, value)`` with i <= j: sums of products of design columns i and j per fold (cell 0, 0 counts the rows).

    Rows that miss a number or the target are left out.  Tasks multiply batches as matrices and hand on one matrix per fold."""
    numbers = [*design.numeric, design.target]
    levels = {c: {v: i for i, v in enumerate(lv)} for c, lv in design.levels.items()}
    size = len(design.names)
    base = df.dropna(subset=[*numbers, fold_col]).select(F.col(fold_col).cast("bigint").alias("fold"), *[F.col(c).cast("double") for c in numbers],
                                                         *[F.col(c).cast("string") for c in levels])

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            n = batch.num_rows
            x = np.zeros((n, size))
            x[:, 0] = 1.0
            for k, c in enumerate(numbers):
                x[:, k + 1 if k < len(numbers) - 1 else size - 1] = batch.column(k + 1).to_numpy(zero_copy_only=False)
            at = len(numbers)
            for k, codes in enumerate(levels.values()):
                found = batch.column(len(numbers) + 1 + k).dictionary_encode()
                place = np.array([codes.get(v, -1) for v in found.dictionary.to_pylist()] + [-1])
                code = place[found.indices.fill_null(len(place) - 1).to_numpy(zero_copy_only=False)]
                hit = np.flatnonzero(code >= 0)
                x[hit, at + code[hit]] = 1.0
                at += len(codes)
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            for f in np.unique(fold):
                own = x[fold == f]
                total[int(f)] = total.get(int(f), 0.0) + own.T @ own
        i, j = np.triu_indices(size)
        for f, m in total.items():
            yield pa.record_batch([pa.array(np.full(len(i), f, np.int64)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                   pa.array(m[i, j])], names=["fold", "i", "j", "value"])

    return base.mapInArrow(run, "fold bigint, i int, j int, value double").groupBy("fold", "i", "j").agg(F.sum("value").alias("value"))


def fold_matrices(cells: DataFrame, size: int) -> dict[int, np.ndarray]:
    """{fold: symmetric matrix of products}, collected: folds x columns squared values."""
    out: dict[int, np.ndarray] = {}
    for r in cells.collect():
        m = out.setdefault(int(r["fold"]), np.zeros((size, size)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["value"]
    return out


def solve(gram: np.ndarray, penalty: float = 0.0) -> np.ndarray:
    """Coefficients (intercept first) of the least squares of the last column on the others.

    ``penalty`` shrinks each slope by its column's own variance, the intercept not at all; without, collinear columns share
    their effect (least norm)."""
    n = gram[0, 0]
    if n <= 0:
        return np.zeros(len(gram) - 1)
    mean = gram[0, 1:] / n
    centred = gram[1:, 1:] - n * np.outer(mean, mean)
    xx, xy = centred[:-1, :-1], centred[:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(xx), 0.0))
    used = np.flatnonzero(scale > 1e-9 * np.sqrt(np.maximum(np.diag(gram)[1:-1], 1e-300)))
    slope = np.zeros(len(xy))
    if len(used):
        corr = xx[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        values, vectors = np.linalg.eigh(corr)
        kept = values > 1e-10 * values[-1]
        values, vectors = values[kept], vectors[:, kept]
        slope[used] = vectors @ ((vectors.T @ (xy[used] / scale[used])) / (values + penalty)) / scale[used]
    return np.concatenate(([mean[-1] - slope @ mean[:-1]], slope))


def squared_error(gram: np.ndarray, coef: np.ndarray) -> float:
    """Mean squared error of coefficients on the rows behind a matrix of products, computed around the mean."""
    n = gram[0, 0]
    if n <= 0:
        return float("nan")
    mean = gram[0, 1:] / n
    centred = gram[1:, 1:] - n * np.outer(mean, mean)
    way = np.concatenate((-coef[1:], [1.0]))
    shift = mean[-1] - coef[0] - coef[1:] @ mean[:-1]
    return float(max(way @ centred @ way, 0.0) / n + shift * shift)


def fold_models(matrices: dict[int, np.ndarray], penalty: float = 0.0) -> dict[int, np.ndarray]:
    """{fold: coefficients fitted on all other folds}: the total minus the fold's own moments."""
    total = sum(matrices.values())
    return {k: solve(total - m, penalty) for k, m in matrices.items()}


def penalty_path(matrices: dict[int, np.ndarray], penalties: Sequence[float]) -> list[tuple[float, int, str, float]]:
    """(penalty, fold, set, mse) for every penalty and fold, on its training and test rows, without reading rows."""
    total, out = sum(matrices.values()), []
    for p in penalties:
        for k, coef in fold_models(matrices, p).items():
            out.append((float(p), k, "train", squared_error(total - matrices[k], coef)))
            out.append((float(p), k, "test", squared_error(matrices[k], coef)))
    return out


def chosen_penalty(path: Sequence[tuple[float, int, str, float]]) -> float:
    """The penalty with the least mean test error over the folds; of equal ones the largest."""
    by: dict[float, list[float]] = {}
    for p, _, part, mse in path:
        if part == "test":
            by.setdefault(p, []).append(mse)
    return min(by, key=lambda p: (float(np.mean(by[p])), -p))


def fold_losses(df: DataFrame, design: Design, models: dict[int, np.ndarray], fold_col: str = "fold") -> DataFrame:
    """(fold, set, label, prediction): every row scored by every fold model in one pass (rows x folds, no join)."""
    scored = F.array(*[F.struct(F.lit(k).cast("bigint").alias("_k"), design.predict(c).alias("prediction")) for k, c in sorted(models.items())])
    return df.select(F.col(fold_col), F.col(design.target).alias("label"), F.inline(scored)).select(
        F.col("_k").alias("fold"), F.when(F.col(fold_col) == F.col("_k"), "test").otherwise("train").alias("set"), "label", "prediction")
