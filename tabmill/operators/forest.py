"""Scoring rows by fitted regression trees through lookup tables.

A tree of at most 32 leaves is a mask of 32 bits.  The value of a column decides all tests on it, in every tree at once, so a table per column
holds, for each of its cases, the leaves that these tests leave over: the cases of a number lie between the thresholds in use,
those of a category are its levels and "any other".  A row ANDs one table row per column; the single bit that is left names each tree's
leaf.  Leaf values are added in tree order, as the model itself does, so predictions are the same.

The cases of all columns number the cells of a grid, and the model has one value per cell: a worker process works out a cell when a row
first needs it and keeps it for its later tasks, as long as the grid (given by the model alone) is of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cached_property
from math import prod

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEAVES = 32
CELLS = 1 << 23  # cells whose values a worker process keeps (64 MB), of all models
_ROWS = 1024  # rows looked up at a time: the masks of all trees stay in the processor's cache
_KEPT: dict[str, np.ndarray] = {}  # values of cells by model, the latest last; NaN: not worked out yet
_TEST = re.compile(r"If \(feature (\d+) <= (\S+)\)")


def parse_trees(text: str) -> list | None:
    """Trees of a model's ``toDebugString``: a leaf is its value, a test ``(feature, threshold, left, right)``; None if it holds other tests."""
    lines = [x.strip() for x in text.splitlines()]
    lines = [x for x in lines if x.startswith(("If ", "Else ", "Predict:"))]
    at = 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return float(line.split(":", 1)[1])
        test = _TEST.fullmatch(line)
        if test is None:
            raise ValueError(line)
        left = node()
        at += 1  # the matching Else
        return int(test[1]), float(test[2]), left, node()

    trees = []
    try:
        while at < len(lines):
            trees.append(node())
    except ValueError:
        return None
    return trees or None


def _leaves(tree, tests: list, first: int = 0) -> list[float]:
    """Leaf values from left to right; appends (feature, threshold, bits of the left leaves, bits of the right leaves) of every test."""
    if isinstance(tree, float):
        return [tree]
    left = _leaves(tree[2], tests, first)
    right = _leaves(tree[3], tests, first + len(left))
    bits = lambda start, n: ((1 << n) - 1) << start
    tests.append((tree[0], tree[1], bits(first, len(left)), bits(first + len(left), len(right))))
    return left + right


@dataclass
class ForestTables:
    numeric: list[str]
    nominal: dict[str, list[str]]  # {column: levels}
    thresholds: list[np.ndarray]  # per numeric column
    masks: list[np.ndarray]  # per column, (cases, trees)
    values: np.ndarray  # (trees x MAX_LEAVES)

    @classmethod
    def of(cls, trees: list, features: list[str], numeric: list[str], nominal: dict[str, list[str]],
           dummies: dict[tuple[str, str], str]) -> ForestTables | None:
        """Tables of parsed trees over ``features`` (numeric columns and 0/1 ``dummies``); None if a tree has too many leaves."""
        values, tests = np.zeros(len(trees) * MAX_LEAVES), []
        for t, tree in enumerate(trees):
            own: list = []
            leaves = _leaves(tree, own)
            if len(leaves) > MAX_LEAVES:
                return None
            values[t * MAX_LEAVES:t * MAX_LEAVES + len(leaves)] = leaves
            tests += [(t, len(leaves), *x) for x in own]
        start = np.zeros(len(trees), np.uint32)
        for t, tree in enumerate(trees):
            start[t] = (1 << len(_leaves(tree, []))) - 1
        by_feature: dict[str, list] = {}
        for t, _, f, threshold, left, right in tests:
            by_feature.setdefault(features[f], []).append((t, threshold, left, right))
        thresholds, masks = [], []
        for c in numeric:
            own = by_feature.get(c, [])
            cuts = np.array(sorted({x[1] for x in own}))
            table = np.tile(start, (len(cuts) + 1, 1))
            for t, threshold, left, right in own:
                k = int(np.searchsorted(cuts, threshold))
                table[:k + 1, t] &= np.uint32(left | ~right & 0xFFFFFFFF)  # at or below the threshold: not the right leaves
                table[k + 1:, t] &= np.uint32(right | ~left & 0xFFFFFFFF)
            thresholds.append(cuts)
            masks.append(table)
        for c, levels in nominal.items():
            table = np.tile(start, (len(levels) + 1, 1))
            for i, level in enumerate(levels):
                for t, threshold, left, right in by_feature.get(dummies[c, level], []):
                    for case in range(len(levels) + 1):
                        goes_left = float(case == i) <= threshold
                        table[case, t] &= np.uint32((~right if goes_left else ~left) & 0xFFFFFFFF)
            masks.append(table)
        return cls(list(numeric), dict(nominal), thresholds, masks, values)

    @property
    def sizes(self) -> list[int]:
        """Number of cases of each column."""
        return [len(m) for m in self.masks]

    @cached_property
    def digest(self) -> str:
        h = hashlib.sha256(repr((self.numeric, self.nominal, self.sizes)).encode())
        for x in (*self.thresholds, *self.masks, self.values):
            h.update(np.ascontiguousarray(x).tobytes())
        return h.hexdigest()

    def _cells(self) -> np.ndarray:
        """The kept values of this model's cells; those of models that were not used for longest make room."""
        known = _KEPT.pop(self.digest, None)
        if known is None:
            room = CELLS - prod(self.sizes)
            while _KEPT and sum(map(len, _KEPT.values())) > room:
                del _KEPT[next(iter(_KEPT))]
            known = np.full(prod(self.sizes), np.nan)
        _KEPT[self.digest] = known
        return known

    def case(self, column: int, x: np.ndarray) -> np.ndarray:
        """Cases of a column's values (level positions of a category)."""
        if column < len(self.numeric):
            return np.searchsorted(self.thresholds[column], checked(self.numeric[column], x), side="left")
        return np.asarray(x)

    def part(self, column: int, x: np.ndarray) -> np.ndarray:
        """What a column's values add to the number of a row's cell."""
        return self.case(column, x).astype(np.int64) * prod(self.sizes[column + 1:])

    def finish(self, cells: np.ndarray) -> np.ndarray:
        """Predictions of cells."""
        if prod(self.sizes) > CELLS:
            found, back = np.unique(cells, return_inverse=True)
            return self._of_cells(found)[back].reshape(cells.shape)
        known = self._cells()
        out = known[cells]
        new = np.isnan(out)
        if new.any():
            found = np.unique(cells[new])
            known[found] = self._of_cells(found)
            out[new] = known[cells[new]]
        return out

    def _of_cells(self, cells: np.ndarray) -> np.ndarray:
        cases = []
        for size in reversed(self.sizes):
            cells, case = np.divmod(cells, size)
            cases.append(case)
        return self._of_cases(cases[::-1])

    def _of_cases(self, cases: list[np.ndarray]) -> np.ndarray:
        trees = self.values.size // MAX_LEAVES
        offset = np.arange(trees, dtype=np.int32) * MAX_LEAVES - 127
        n = len(cases[0]) if cases else 0
        out = np.empty(n)
        for a in range(0, n, _ROWS):
            left = self.masks[0][cases[0][a:a + _ROWS]]
            for table, case in zip(self.masks[1:], cases[1:]):
                left &= table[case[a:a + _ROWS]]
            leaf = (left.astype(np.float32).view(np.int32) >> 23) + offset  # the exponent of a power of two is its bit
            out[a:a + _ROWS] = np.add.accumulate(self.values[leaf], axis=1)[:, -1] / trees
        return out

    def predict(self, columns: list[np.ndarray]) -> np.ndarray:
        """Predictions of rows given by their numeric values and level positions, in the order of ``numeric`` and ``nominal``."""
        if not columns or prod(self.sizes) > CELLS:
            return self._of_cases([self.case(i, x) for i, x in enumerate(columns)])
        return self.finish(sum(self.part(i, x) for i, x in enumerate(columns)))

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``: batches of rows, numbers as they are and categories as level positions."""
        tables = self

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            return pd.Series(tables.predict([c.to_numpy() for c in columns]))

        return df.withColumn("prediction", predict(*code_columns(self.numeric, self.nominal)))


def checked(name: str, x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    if np.isnan(x).any():
        raise ValueError(f"column {name} holds a NULL or NaN")
    return x


def code_columns(numeric: list[str], nominal: dict[str, list[str]]) -> list[Column]:
    """Numbers as they are, categories as the positions of their levels."""
    cols = [F.col(c).cast("double") for c in numeric]
    for c, levels in nominal.items():
        place = F.array_position(F.array(*map(F.lit, levels)), F.col(c).cast("string")).cast("int")
        cols.append(F.when(place > 0, place - 1).otherwise(len(levels)))  # NULL and unseen levels: none of them
    return cols
