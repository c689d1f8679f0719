"""Several fitted regressors scored together.

A tree, a forest or a linear model is a *sum of parts*: each column's value adds a part of its own (to the number of a cell, or to the linear
predictor), and the sum alone decides the prediction.  A row is therefore read once for all learners; another value of one column (a grid
point, an interval's edge, a donor's value) exchanges one part, without a row of its own.  Sums over rows are made per task and only they move.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .forest import ForestTables, checked, code_columns

MOST_CELLS = 1 << 62  # a cell's number is an integer of 64 bits


@dataclass
class LinearTables:
    """A linear model: a slope per number, a coefficient per level (none for any other level)."""

    numeric: list[str]
    nominal: dict[str, list[str]]
    intercept: float
    slopes: list[float]
    levels: list[np.ndarray]  # per category: its levels' coefficients, then 0

    @classmethod
    def of(cls, coefficients: Sequence[float], intercept: float, features: list[str], numeric: list[str], nominal: dict[str, list[str]],
           dummies: dict[tuple[str, str], str]) -> LinearTables:
        by = dict(zip(features, map(float, coefficients)))
        return cls(list(numeric), dict(nominal), float(intercept), [by[c] for c in numeric],
                   [np.array([*[by[dummies[c, lv]] for lv in levels], 0.0]) for c, levels in nominal.items()])

    def part(self, column: int, x: np.ndarray) -> np.ndarray:
        if column < len(self.numeric):
            return self.slopes[column] * checked(self.numeric[column], x)
        return self.levels[column - len(self.numeric)][np.asarray(x)]

    def finish(self, sums: np.ndarray) -> np.ndarray:
        return sums + self.intercept


def _without(parts: list[np.ndarray]) -> list[np.ndarray]:
    """For each of ``parts`` the sum of all others."""
    none = np.zeros_like(parts[0])
    before, after = [none], [none]
    for p in parts[:-1]:
        before.append(before[-1] + p)
    for p in reversed(parts[1:]):
        after.append(after[-1] + p)
    return [b + a for b, a in zip(before, reversed(after))]


class Stacked:
    """Scorer of several learners over the same columns: a row comes back once per learner, named in ``learner``.

    Explanation operators that know it (``isinstance``) score all learners in one pass and return a ``learner`` column."""

    def __init__(self, models: dict[str, ForestTables | LinearTables]):
        first = next(iter(models.values()))
        self.names, self.models = list(models), list(models.values())
        self.numeric, self.nominal = first.numeric, first.nominal
        self.columns = [*self.numeric, *self.nominal]

    # ---------------------------------------------------------------- columns of a row, as tasks read them

    def _groups(self) -> list[list[str]]:
        """Categories whose level positions share an integer."""
        out: list[list[str]] = []
        room = 0
        for c, levels in self.nominal.items():
            size = len(levels) + 1
            if room < size:
                out.append([])
                room = MOST_CELLS
            out[-1].append(c)
            room //= size
        return out

    def packed(self, prefix: str) -> list[Column]:
        """Numbers, then integers that hold the level positions: what :meth:`_unpacked` reads."""
        codes = dict(zip(self.columns, code_columns(self.numeric, self.nominal)))
        cols = [codes[c] for c in self.numeric]
        for group in self._groups():
            whole = F.lit(0).cast("bigint")
            for c in group:
                whole = whole * (len(self.nominal[c]) + 1) + codes[c]
            cols.append(whole)
        return [x.alias(f"{prefix}{i}") for i, x in enumerate(cols)]

    def packed_names(self, prefix: str) -> list[str]:
        return [f"{prefix}{i}" for i in range(len(self.numeric) + len(self._groups()))]

    def _unpacked(self, batch: pa.RecordBatch, prefix: str) -> list[np.ndarray]:
        cols = [batch.column(f"{prefix}{i}").to_numpy(zero_copy_only=False) for i in range(len(self.numeric) + len(self._groups()))]
        place = {}
        for group, x in zip(self._groups(), cols[len(self.numeric):]):
            for c in reversed(group):
                x, place[c] = np.divmod(x, len(self.nominal[c]) + 1)
        return [*cols[:len(self.numeric)], *[place[c] for c in self.nominal]]

    def _rest(self, model, values: list[np.ndarray | None], n: int):
        """Sum of the parts of all columns that have values (None: left out)."""
        total = None
        for i, x in enumerate(values):
            if x is not None:
                p = model.part(i, x)
                total = p if total is None else total + p
        return np.zeros(n, np.int64 if isinstance(model, ForestTables) else float) if total is None else total

    def predict(self, values: list[np.ndarray]) -> np.ndarray:
        """(rows, learners)"""
        return np.column_stack([m.finish(self._rest(m, values, len(values[0]))) for m in self.models])

    def _at(self, values: list[np.ndarray], column: int, points: np.ndarray) -> np.ndarray:
        """(rows, learners, points): predictions with ``column`` set to each of ``points``; its own values are not read."""
        values = [None if i == column else x for i, x in enumerate(values)]
        n = max((len(x) for x in values if x is not None), default=0)
        return np.stack([m.finish(self._rest(m, values, n)[:, None] + m.part(column, points)[None, :]) for m in self.models], axis=1)

    # ---------------------------------------------------------------- passes over the rows

    def __call__(self, df: DataFrame) -> DataFrame:
        keep = [c for c in df.columns if c not in ("prediction", "learner")]
        out = self.appended(df, "_ys").select(*keep, F.posexplode("_ys").alias("_m", "prediction"))
        return out.select(*keep, self.name_of("_m"), "prediction")

    def appended(self, df: DataFrame, out_col: str) -> DataFrame:
        """``df`` with the array of all learners' predictions."""
        stack = self

        @F.pandas_udf("array<double>")
        def predict(*columns: pd.Series) -> pd.Series:
            return pd.Series(list(stack.predict([c.to_numpy() for c in columns])))

        return df.withColumn(out_col, predict(*code_columns(self.numeric, self.nominal)))

    def name_of(self, index: str) -> Column:
        return F.get(F.array(*map(F.lit, self.names)), F.col(index)).alias("learner")

    def curves(self, df: DataFrame, feature: str, grid: Sequence[float], id_col: str) -> DataFrame:
        """``learner, feature_val, prediction, id``: every row at every grid value, one row read for all of them."""
        stack, column, points = self, self.columns.index(feature), np.array(grid, float)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                y = stack._at(stack._unpacked(b, "_c"), column, points).reshape(len(b), -1)
                ends = pa.array(np.arange(len(b) + 1, dtype=np.int32) * y.shape[1])
                yield pa.RecordBatch.from_arrays([b.column("_id"), pa.ListArray.from_arrays(ends, pa.array(y.ravel()))], ["_id", "_ys"])

        rows = self._point(df, feature, F.col(id_col).cast("bigint").alias("_id"))
        cells = F.array(*[F.struct(F.lit(n).alias("learner"), F.lit(float(v)).alias("feature_val")) for n in self.names for v in grid])
        out = rows.mapInArrow(score, "_id bigint, _ys array<double>").select("_id", F.posexplode("_ys").alias("_at", "prediction"))
        cell = F.get(cells, F.col("_at"))
        return out.select(cell["learner"].alias("learner"), cell["feature_val"].alias("feature_val"), "prediction", F.col("_id").alias("id"))

    def curve_means(self, df: DataFrame, feature: str, grid: Sequence[float]) -> DataFrame:
        """``learner, feature_val, prediction``: means of :meth:`curves` from sums per task."""
        stack, column, points = self, self.columns.index(feature), np.array(grid, float)
        schema = "_m int, feature_val double, total double, n bigint"

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros((len(stack.models), len(points))), 0
            for b in batches:
                total += stack._at(stack._unpacked(b, "_c"), column, points).sum(axis=0)
                n += len(b)
            if n:
                m, k = np.indices(total.shape).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.int32()), pa.array(points[k]), pa.array(total.ravel()), pa.array(np.full(m.size, n))],
                                                 ["_m", "feature_val", "total", "n"])

        sums = self._point(df, feature).mapInArrow(add, schema).groupBy("_m", "feature_val").agg((F.sum("total") / F.sum("n")).alias("prediction"))
        return sums.select(self.name_of("_m"), "feature_val", "prediction")

    def _point(self, df: DataFrame, feature: str, *keep: Column) -> DataFrame:
        """Packed columns with ``feature`` left blank: it is set to the points of a grid."""
        return df.withColumn(feature, F.lit(0.0)).select(*keep, *self.packed("_c"))

    def edge_sums(self, df: DataFrame, feature: str, interval: Column, breaks: Sequence[float]) -> DataFrame:
        """``learner, _k, total, n``: per interval (1-based, between two of ``breaks``) the sum of the differences between the predictions at
        its upper and lower edge, and the number of rows."""
        stack, column, points = self, self.columns.index(feature), np.array(breaks, float)
        shape = (len(self.models), len(points) - 1)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(shape), np.zeros(shape[1])
            for b in batches:
                values, k = stack._unpacked(b, "_c"), b.column("_k").to_numpy(zero_copy_only=False) - 1
                rest = [None if i == column else x for i, x in enumerate(values)]
                n += np.bincount(k, minlength=shape[1])
                for i, m in enumerate(stack.models):
                    others, edges = stack._rest(m, rest, len(b)), m.part(column, points)
                    steps = m.finish(others + edges[k + 1]) - m.finish(others + edges[k])
                    total[i] += np.bincount(k, weights=steps, minlength=shape[1])
            m, k = np.indices(shape).reshape(2, -1)
            seen = n[k] > 0
            yield pa.RecordBatch.from_arrays([pa.array(m[seen], pa.int32()), pa.array(k[seen] + 1, pa.int32()), pa.array(total.ravel()[seen]),
                                              pa.array(n[k][seen].astype(np.int64))], ["_m", "_k", "total", "n"])

        sums = df.select(interval.cast("int").alias("_k"), *self.packed("_c")).mapInArrow(add, "_m int, _k int, total double, n bigint")
        return sums.groupBy("_m", "_k").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).select(self.name_of("_m"), "_k", "total", "n")

    def swap_errors(self, pairs: DataFrame, features: Sequence[str], repetitions: int) -> DataFrame:
        """``learner, _feature, _rep, err``: mean absolute errors of rows (packed ``_c``, target ``_y``) that take one feature's value from
        their donor (packed ``_d``), per repetition ``_rep``; ``_feature`` NULL: the rows as they are."""
        stack = self
        swapped = [self.columns.index(f) if f in self.columns else -1 for f in features]  # a column that no model reads changes nothing
        shape = (len(self.models), len(features) + 1, repetitions)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(shape), np.zeros(repetitions)
            for b in batches:
                own, donor = stack._unpacked(b, "_c"), stack._unpacked(b, "_d")
                y, rep = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_rep"))
                n += np.bincount(rep, minlength=repetitions)
                for i, m in enumerate(stack.models):
                    parts = [m.part(k, x) for k, x in enumerate(own)]
                    others = _without(parts)
                    whole = m.finish(others[0] + parts[0])
                    for j, k in enumerate([-1, *swapped]):
                        p = whole if k < 0 else m.finish(others[k] + m.part(k, donor[k]))
                        total[i, j] += np.bincount(rep, weights=np.abs(y - p), minlength=repetitions)
            m, f, r = np.indices(shape).reshape(3, -1)
            seen = n[r] > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[seen], pa.int32()) for x in (m, f, r)] + [pa.array(total.ravel()[seen]), pa.array(n[r][seen].astype(np.int64))],
                ["_m", "_f", "_rep", "total", "n"])

        sums = pairs.mapInArrow(add, "_m int, _f int, _rep int, total double, n bigint").groupBy("_m", "_f", "_rep").agg(
            (F.sum("total") / F.sum("n")).alias("err"))
        return sums.select(self.name_of("_m"), F.get(F.array(F.lit(None).cast("string"), *map(F.lit, features)), F.col("_f")).alias("_feature"), "_rep", "err")
