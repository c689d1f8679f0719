"""Trained preparation ("recipe"): filter step, level dictionaries, full one-hot encoding.

``Recipe(...).fit(train)`` learns, in ONE grouped aggregate, the sorted level list
of every nominal column for every group (task); ``RecipeModel.transform`` is then a
pure projection (plus the optional filter), so preparing all tasks costs one pass
over the training data instead of one pass per task.

Encoding decisions:

* levels sort alphabetically; every level gets its own 0/1 column (full one-hot,
  not reference-coded, and no extra "invalid" slot);
* a value absent from the group's training levels (or NULL) makes that row's dummy
  columns NULL; ``unseen='drop'`` (default) removes such rows (``unseen_rows`` counts
  them), ``'zero'`` keeps them with all-zero dummies, ``'keep'`` leaves the NULLs;
* the target keeps its text; its level list is remembered for label indexing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import categorical as cat
from . import columns as co


def level_slug(level: str) -> str:
    s = re.sub(r"[^0-9a-zA-Z]+", "_", str(level)).strip("_").lower()
    return s or "blank"


def dummy_names(levels: dict[str, list[str]]) -> dict[tuple[str, str], str]:
    """One unique column name per (column, level): ``column_level`` in snake case; levels that read
    the same (``A+``, ``A-``) get ``_2``, ``_3``, ... in level order."""
    out: dict[tuple[str, str], str] = {}
    taken: set[str] = set()
    for c, lv in levels.items():
        for level in lv:
            base = f"{c}_{level_slug(level)}"
            name, k = base, 1
            while name in taken:
                k += 1
                name = f"{base}_{k}"
            taken.add(name)
            out[(c, level)] = name
    return out


def one_hot(df: DataFrame, levels: dict[str, list[str]], drop_source: bool = True) -> DataFrame:
    """Full one-hot for columns with known levels: ``col_level`` = 1 if equal, 0 if another known
    level, NULL if the value is not a known level (or NULL)."""
    exprs = {name: F.when(F.col(c).isin(*levels[c]), (F.col(c) == level).cast("int"))
             for (c, level), name in dummy_names(levels).items()}
    out = df.withColumns(exprs)
    return out.drop(*levels) if drop_source else out


@dataclass
class Recipe:
    """Preparation spec.  ``group`` (e.g. the task column) gets its own level dictionary per value."""

    target: str
    key: str | None = None
    group: str | None = None
    predictors: Sequence[str] | None = None
    exclude: Sequence[str] = ()
    filter: Column | None = None
    filter_on: Sequence[str] = ("train", "test")
    unseen: str = "drop"

    def roles(self, df: DataFrame) -> dict[str, list[str]]:
        """outcome / id / group / nominal predictors / numeric predictors."""
        skip = {self.target, self.key, self.group, *self.exclude} - {None}
        preds = list(self.predictors) if self.predictors is not None else [c for c in df.columns if c not in skip]
        nominal = [c for c in co.categorical_columns(df) if c in preds]
        numeric = [c for c in co.numeric_columns(df) if c in preds]
        return {"outcome": [self.target], "id": [self.key] if self.key else [],
                "group": [self.group] if self.group else [], "nominal": nominal, "numeric": numeric}

    def _filtered(self, df: DataFrame, phase: str) -> DataFrame:
        if self.filter is not None and phase in self.filter_on:
            return df.filter(self.filter)
        return df

    def fit(self, train: DataFrame) -> RecipeModel:
        roles = self.roles(train)
        data = self._filtered(train, "train")
        group = [self.group] if self.group else []
        target_is_nominal = self.target in co.categorical_columns(train)
        cols = roles["nominal"] + ([self.target] if target_is_nominal else [])
        counts = cat.level_counts(data, cols, group).select(*group, "column", "level", "n")
        rows = counts.collect()  # one row per dummy column of the prepared frame
        levels: dict = {}
        sizes: dict = {}
        for r in rows:
            g = r[self.group] if self.group else None
            levels.setdefault(g, {}).setdefault(r["column"], []).append(r["level"])
            sizes.setdefault(g, {}).setdefault(r["column"], 0)
            sizes[g][r["column"]] += int(r["n"])
        levels = {g: {c: sorted(v) for c, v in d.items()} for g, d in levels.items()}
        # training rows per group (largest non-null count over the encoded columns): a sizing hint
        group_rows = {g: max(d.values()) for g, d in sizes.items()}
        return RecipeModel(self, roles, levels, group_rows)


@dataclass
class RecipeModel:
    recipe: Recipe
    roles: dict[str, list[str]]
    levels: dict = field(default_factory=dict)  # {group value or None: {column: [levels]}}
    group_rows: dict = field(default_factory=dict)  # {group value or None: training rows (hint)}

    @property
    def rows_hint(self) -> int | None:
        return sum(self.group_rows.values()) if self.group_rows else None

    @property
    def groups(self) -> list:
        return sorted(self.levels, key=lambda g: (g is None, g))

    def union_levels(self, column: str) -> list[str]:
        out = set()
        for d in self.levels.values():
            out.update(d.get(column, []))
        return sorted(out)

    def dummy_map(self) -> dict[tuple[str, str], str]:
        """Dummy column of every (nominal column, level), unique names."""
        return dummy_names({c: self.union_levels(c) for c in self.roles["nominal"]})

    def dummy_columns(self) -> list[str]:
        return list(self.dummy_map().values())

    def label_levels(self, group=None) -> list[str]:
        return self.levels.get(group, {}).get(self.recipe.target, [])

    def _known(self, column: str) -> Column:
        """TRUE when the row's value is a training level of the row's own group."""
        r = self.recipe
        if not r.group:
            return F.col(column).isin(*self.levels.get(None, {}).get(column, []))
        expr = None
        for g in self.groups:
            lv = self.levels[g].get(column, [])
            cond = F.col(r.group) == F.lit(g)
            expr = (F.when(cond, F.col(column).isin(*lv)) if expr is None
                    else expr.when(cond, F.col(column).isin(*lv)))
        return expr.otherwise(F.lit(False)) if expr is not None else F.lit(False)

    def transform(self, df: DataFrame, phase: str = "test") -> DataFrame:
        """Prepared rows: id, group, outcome, numeric predictors, dummy columns.

        One membership flag per nominal column is computed first (the per-group CASE is
        evaluated once per column, not once per dummy), unseen rows are filtered on the
        flags, then each dummy is a cheap comparison -- small generated code, one stage.
        """
        r = self.recipe
        if r.unseen not in ("drop", "zero", "keep"):
            raise ValueError("unseen must be 'drop', 'zero' or 'keep'")
        data = r._filtered(df, phase)
        if r.group:
            data = data.filter(F.col(r.group).isin(*[g for g in self.groups if g is not None]))
        nominal = self.roles["nominal"]
        flags = {f"_known_{i}": self._known(c) for i, c in enumerate(nominal)}
        head = self.roles["id"] + self.roles["group"] + [r.target] + self.roles["numeric"]
        data = data.select(*head, *nominal, *[e.alias(n) for n, e in flags.items()])
        if r.unseen == "drop" and flags:
            cond = F.lit(True)
            for n in flags:
                cond = cond & F.col(n)
            data = data.filter(cond)
        dummies, names = [], self.dummy_map()
        for i, c in enumerate(nominal):
            flag = F.col(f"_known_{i}")
            for lv in self.union_levels(c):
                hit = (F.col(c) == lv).cast("int")
                if r.unseen == "zero":
                    e = F.when(flag, hit).otherwise(F.lit(0))
                elif r.unseen == "drop":
                    e = hit
                else:
                    e = F.when(flag, hit)
                dummies.append(e.alias(names[(c, lv)]))
        return data.select(*head, *dummies)

    def unseen_rows(self, df: DataFrame, phase: str = "test") -> DataFrame:
        """Rows per group that ``unseen='drop'`` leaves out: a nominal value is NULL or was not seen in training.
        ``(group, n_rows, n_dropped)``; a group without prepared rows is absent."""
        data = self.recipe._filtered(df, phase)
        if self.recipe.group:
            data = data.filter(F.col(self.recipe.group).isin(*[g for g in self.groups if g is not None]))
        known = F.lit(True)
        for c in self.roles["nominal"]:
            known = known & F.coalesce(self._known(c), F.lit(False))
        return data.groupBy(*self.roles["group"]).agg(
            F.count(F.lit(1)).cast("bigint").alias("n_rows"),
            F.sum((~known).cast("bigint")).alias("n_dropped"))

    def juice(self, train: DataFrame) -> DataFrame:
        return self.transform(train, phase="train")

    def bake(self, test: DataFrame, scope: str = "own") -> DataFrame:
        """``scope='own'``: each group's rows with its own levels.  ``scope='all'``: every group's
        preparation applied to all test rows (rows fan out by the bounded number of groups)."""
        r = self.recipe
        if scope == "own" or not r.group:
            return self.transform(test, phase="test")
        if scope != "all":
            raise ValueError("scope must be 'own' or 'all'")
        groups = [g for g in self.groups if g is not None]
        fan = test.withColumn(r.group, F.explode(F.array(*[F.lit(g) for g in groups])))
        return self.transform(fan, phase="test")
