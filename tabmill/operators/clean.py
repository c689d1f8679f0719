"""Whole-table cleaning compositions.

``combine``: the house-table cleaning -- names, categorical typing, null-share
column selection, NA rows, rare and dominant level lumping, single-level column
removal.  Two small aggregates reach the driver (one row per column; one row per
level), everything else is a lazy projection/filter over the scan.

``nth_row_dataset``: one scale row per assessment, age bucket, level filters,
unused levels forgotten.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import age_bucket
from ..functions.names import clean_names
from . import categorical as cat
from . import columns as colops
from .split import dense_row_id, materialize

# Name patterns that make a column categorical, and the defaults of the cleaning.
CATEGORICAL_PATTERNS = ("year", "yr", "class")
PERC_MISS = 0.2
PERC_LUMP = 0.1
DOMINANT_LUMP = -0.89
# Additional columns typed as categorical for the house table.
HOUSE_FACTOR_LIST = [
    "overall_cond", "overall_qual", "mo_sold", "kitchen_abv_gr", "half_bath", "garage_cars",
    "full_bath", "fireplaces", "bsmt_half_bath", "bsmt_full_bath", "bedroom_abv_gr",
]


def type_columns(raw: DataFrame, factor_list: Iterable[str] = HOUSE_FACTOR_LIST,
                 patterns: Iterable[str] = CATEGORICAL_PATTERNS) -> DataFrame:
    """Clean names; text, name-pattern and listed columns become categorical (text).

    Listed names that are absent are skipped (the original errored on them).
    """
    x = clean_names(raw)
    cat_cols = set(colops.categorical_columns(x)) | set(colops.columns_matching(x, patterns))
    cat_cols |= {c for c in factor_list if c in x.columns}
    return colops.as_categorical(x, [c for c in x.columns if c in cat_cols])


def combine(raw: DataFrame, factor_list: Iterable[str] = HOUSE_FACTOR_LIST, perc_miss: float = PERC_MISS,
            perc_lump: float = PERC_LUMP, dominant_lump: float = DOMINANT_LUMP, id_col: str = "id",
            align: str = "id", keep_single_rare: bool = False) -> DataFrame:
    """Clean the house table.  Output: ``id``, kept numeric columns, kept categorical columns.

    ``align='id'`` (default) keeps the rows complete in every kept column -- what
    joining the numeric and categorical halves on the real key gives, computed
    without the join.  ``align='position'`` reproduces pairing the two halves by
    row position after dropping NA rows separately (rows can be mismatched).
    """
    x = type_columns(raw, factor_list)
    if id_col not in x.columns:
        raise ValueError(f"key column {id_col!r} is required")
    # read by the null shares, the level counts and the result: what made the rows runs once
    x = materialize(x)
    kept = colops.kept_column_names(x, perc_miss, id_col)
    numeric = [c for c in colops.numeric_columns(x) if c in kept]
    factors = [c for c in colops.categorical_columns(x) if c in kept]

    x = x.select(id_col, *kept)
    complete = x.na.drop("any", subset=kept)
    lumped, surviving = [], []
    for c, s in (cat.level_shares(complete, factors, perc_lump) if factors else {}).items():
        lump_rare = s.rare > (1 if keep_single_rare else 0)
        if not lump_rare and s.rare:  # one rare level that stays: its share is too small to dominate
            levels = s.levels
            after = dict(s.frequent)
        else:
            after = dict(s.frequent)
            if lump_rare:
                after[cat.OTHER] = after.get(cat.OTHER, 0) + s.total - sum(s.frequent.values())
            levels = len(after)
        dominant = {lv for lv, n in after.items() if n / s.total > -dominant_lump} if dominant_lump < 0 and s.total else set()
        left = levels - len(dominant) + (1 if dominant and (cat.OTHER not in after or cat.OTHER in dominant) else 0)
        if left > 1:
            surviving.append(c)
            lumped.append(cat.relabelled(c, s.frequent if lump_rare else None, dominant - {cat.OTHER}).alias(c))

    if align == "id":
        return complete.select(id_col, *numeric, *lumped)
    if align != "position":
        raise ValueError("align must be 'id' or 'position'")
    num_half = x.select(id_col, *numeric).na.drop("any", subset=numeric)
    num_half = dense_row_id(num_half, [id_col], "rowid").drop(id_col) if numeric else num_half
    fac_half = dense_row_id(complete.select(id_col, *lumped), [id_col], "rowid")
    return num_half.join(fac_half, "rowid").select(id_col, *numeric, *surviving)


def join_halves(df: DataFrame, key: str = "id") -> DataFrame:
    """The numeric half (NA rows dropped) joined to the categorical half (NA rows dropped) on the key."""
    num = colops.select_numeric(df, [key])
    num = num.na.drop("any", subset=[c for c in num.columns if c != key])
    fac = colops.select_categorical(df, [key])
    fac = fac.na.drop("any", subset=[c for c in fac.columns if c != key])
    return num.join(fac, key, "inner")


def nth_row_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The n-th row (1-based) of each group in ``order``.

    ``row_number() == n`` over a window partitioned by the group.  Catalyst plans a
    partial ``WindowGroupLimit`` before the shuffle, so every map task forwards at
    most ``n`` rows per group: a group holding a third of the data still moves only
    ``n x map tasks`` rows and sorts nothing large.  No global ordering.  ``order``
    must be given because row order is not data in Spark.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n).drop("_rn")


def nth_row_dataset(raw_clean: DataFrame, n: int, filters: dict[str, list[str]], key: str = "assessment_id",
                    order: Sequence[str] = ("scale_set",), drop: Sequence[str] = ("person_id",),
                    birth_col: str = "date_of_birth") -> DataFrame:
    """Per-assessment n-th scale row, with age bucket from the raw birth date and level filters."""
    df = nth_row_per_group(raw_clean, [key], list(order), n)
    df = df.withColumn(birth_col, age_bucket(birth_col))
    cond = F.lit(True)
    for c, levels in filters.items():
        cond = cond & F.col(c).isin(*levels)
    return df.filter(cond).drop(*drop)
