"""Projection, schema and whole-table column statistics operators.

Column statistics (null shares, cardinality checks) are computed in ONE
aggregate over all columns -- a single scan with map-side partial aggregation --
never one job per column.  Their results are one row per column, which is the
only thing brought to the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """All named columns, in the given order; a missing name raises (Catalyst analysis error)."""
    return df.select(*cols)


def select_one_of(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep the named columns that exist, in the given order; warn about unknown ones."""
    names = list(names)
    present = [n for n in names if n in df.columns]
    missing = [n for n in names if n not in df.columns]
    if missing:
        warnings.warn(f"unknown columns ignored: {missing}", stacklevel=2)
    return df.select(*present)


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def select_by_position(df: DataFrame, *positions: int) -> DataFrame:
    """Select by 0-based position; positions may reorder columns."""
    return df.select(*[df.columns[i] for i in positions])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def select_numeric(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    keep = [k for k in keep if k in df.columns]
    cols = numeric_columns(df)
    return df.select(*keep, *[c for c in cols if c not in keep])


def select_categorical(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    keep = [k for k in keep if k in df.columns]
    cols = categorical_columns(df)
    return df.select(*keep, *[c for c in cols if c not in keep])


def columns_matching(df: DataFrame, patterns: Iterable[str]) -> list[str]:
    """Names containing any of the substrings, case-insensitively, in frame order."""
    pats = [p.lower() for p in patterns]
    return [c for c in df.columns if any(p in c.lower() for p in pats)]


def mutate_columns(df: DataFrame, cols: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply a column function to each named column in one projection."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def as_categorical(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Categorical = text with a level dictionary; casting to string is the column half."""
    return mutate_columns(df, cols, lambda c: c.cast("string"))


def cast_by_pattern(df: DataFrame, patterns: Iterable[str] = ("year", "yr", "class")) -> DataFrame:
    return as_categorical(df, columns_matching(df, patterns))


def rename_cols(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``{old: new}``; unknown old names are ignored by Spark, as documented for ``withColumnsRenamed``."""
    return df.withColumnsRenamed(mapping)


def drop_na_rows(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset is not None else None)


def _missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    m = F.col(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        m = m | F.isnan(F.col(c))
    return m


def null_share(df: DataFrame, id_col: str | None = "id") -> DataFrame:
    """Share of missing values per column, long form ``(values, count)``.

    One aggregate over all columns (a single scan, partial aggregation per task),
    then an unpivot of the one-row result.  ``id_col`` is excluded, as the key.
    """
    cols = [c for c in df.columns if c != id_col]
    if not cols:
        return df.sparkSession.createDataFrame([], "values string, count double")
    wide = df.agg(*[F.avg(_missing(df, c).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], cols, "values", "count")


def keep_columns_by_null_share(shares: DataFrame, max_share: float) -> DataFrame:
    """Columns whose missing share is strictly below ``max_share``."""
    return shares.filter(F.col("count") < F.lit(float(max_share)))


def kept_column_names(df: DataFrame, max_share: float, id_col: str | None = "id") -> list[str]:
    """Driver-side list of surviving column names (one row per column: bounded)."""
    rows = keep_columns_by_null_share(null_share(df, id_col), max_share).select("values").collect()
    keep = {r["values"] for r in rows}
    return [c for c in df.columns if c in keep]


def non_constant_columns(df: DataFrame, cols: Iterable[str] | None = None) -> list[str]:
    """Columns with at least two distinct values, NULL counting as a value.

    ``min <> max``, or some but not all values NULL -- per column in one aggregate:
    exact, mergeable, and without the shuffle a ``count(distinct)`` per column costs.
    """
    cols = list(cols) if cols is not None else df.columns
    if not cols:
        return []
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [(F.min(c) != F.max(c)).alias(f"_d{i}"), F.count(c).alias(f"_n{i}")]
    row = df.agg(*aggs).first()
    out = []
    for i, c in enumerate(cols):
        nonnull = row[f"_n{i}"]
        if row[f"_d{i}"] or (0 < nonnull < row["_rows"]):
            out.append(c)
    return out


def drop_constant_cols(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    keep = [k for k in keep if k in df.columns]
    cand = [c for c in df.columns if c not in keep]
    good = set(non_constant_columns(df, cand))
    return df.select(*[c for c in df.columns if c in keep or c in good])


def features_target_split(df: DataFrame, target: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Feature frame (everything but the target) and target frame, sharing the key column."""
    return df.drop(target), df.select(key, target)


def key_check(df: DataFrame, key: Iterable[str], group: Iterable[str] = ()) -> DataFrame:
    """Per group: rows, distinct keys and duplicated keys -- the row-name uniqueness check.

    Two aggregations, both shuffling on (group, key) and then group; the second one
    reads the small per-key counts only.
    """
    group, key = list(group), list(key)
    per_key = df.groupBy(*group, *key).agg(F.count(F.lit(1)).alias("n"))
    out = per_key.groupBy(*group).agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_keys"),
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).cast("bigint").alias("n_duplicated_keys"),
    )
    return out


def assert_unique(df: DataFrame, key: Iterable[str], group: Iterable[str] = ()) -> None:
    """Raise when a key repeats within a group (row names must be unique)."""
    group, key = list(group), list(key)
    dup = df.groupBy(*group, *key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {key} within {group}: {dup[0].asDict()}")
