"""Categorical columns: level dictionaries, level frequencies and level lumping.

A categorical column is text plus a level dictionary.  Level counts for ALL
categorical columns come from one unpivot + grouped count (partial aggregation
before the shuffle).  Lumping brings only the levels above the share to the driver:
at most ``1 / share`` per column, whatever the number of levels.  A full dictionary
(:func:`level_dictionary`) is as large as the one-hot frame it describes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "Other"


def level_counts(df: DataFrame, cols: Iterable[str], group: Iterable[str] = ()) -> DataFrame:
    """``(group..., column, level, n)`` for every non-null level of every column, one pass."""
    cols, group = list(cols), list(group)
    if not cols:
        spark = df.sparkSession
        fields = ", ".join(f"`{g}` string" for g in group)
        return spark.createDataFrame([], (fields + ", " if fields else "") + "column string, level string, n bigint")
    long = df.select(*group, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        group, cols, "column", "level")
    return long.filter(F.col("level").isNotNull()).groupBy(*group, "column", "level").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def level_freq(df: DataFrame, cols: Iterable[str], group: Iterable[str] = ()) -> DataFrame:
    """Level counts and their share of the column's non-null values (per group)."""
    group = list(group)
    counts = level_counts(df, cols, group)
    totals = counts.groupBy(*group, "column").agg(F.sum("n").alias("_total"))
    return counts.join(totals, [*group, "column"]).select(
        *group, "column", "level", "n", (F.col("n") / F.col("_total")).alias("share"))


def level_dictionary(df: DataFrame, cols: Iterable[str], group: Iterable[str] = ()) -> dict:
    """``{(group values..., column): [sorted levels]}``, one entry per column of a one-hot frame."""
    group = list(group)
    out: dict = {}
    for r in level_counts(df, cols, group).select(*group, "column", "level").collect():
        out.setdefault(tuple(r[g] for g in group) + (r["column"],), []).append(r["level"])
    return {k: sorted(v) for k, v in out.items()}


class LevelShares:
    """Of one column: the levels above a share with their counts, the number of levels, and the total count.

    ``1 / share`` bounds the levels held; those below are only counted."""

    def __init__(self, frequent: dict[str, int] | None = None, levels: int = 0, total: int = 0):
        self.frequent, self.levels, self.total = frequent or {}, levels, total

    @property
    def rare(self) -> int:
        return self.levels - len(self.frequent)


def level_shares(df: DataFrame, cols: Iterable[str], share: float) -> dict[str, LevelShares]:
    """Per column the levels whose share of the non-null values exceeds ``share``; shares are computed on the
    executors and only those levels are collected."""
    cols = list(cols)
    counts = level_counts(df, cols).persist(StorageLevel.MEMORY_AND_DISK)  # counted once, read three times
    try:
        totals = counts.groupBy("column").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("levels"))
        frequent = F.col("n") / F.col("total") > F.lit(float(share))
        rows = counts.join(totals, "column").filter(frequent).select("column", "level", "n").collect()
        sums = totals.collect()
    finally:
        counts.unpersist()
    out = {c: LevelShares() for c in cols}
    for r in sums:
        out[r["column"]] = LevelShares({}, int(r["levels"]), int(r["total"]))
    for r in rows:
        out[r["column"]].frequent[r["level"]] = int(r["n"])
    return out


def relabelled(c: str, kept: Iterable[str] | None, merged: Iterable[str] = ()) -> Column:
    """Levels outside ``kept`` (None: all are kept) and levels in ``merged`` become ``Other``; NULL stays NULL."""
    x = F.col(c)
    out = F.when(x.isNull(), x)
    if merged := sorted(merged):
        out = out.when(x.isin(*merged), F.lit(OTHER))
    if kept is None:
        return out.otherwise(x) if merged else x
    kept = sorted(kept)
    return out.when(x.isin(*kept), x).otherwise(F.lit(OTHER)) if kept else out.otherwise(F.lit(OTHER))


def lump(df: DataFrame, cols: Iterable[str], prop: float, keep_single_rare: bool = False) -> DataFrame:
    """Lump levels of every listed column into ``Other`` by share (one aggregate + one projection).

    ``prop >= 0`` merges levels with share <= prop (with ``keep_single_rare`` a lone one stays);
    ``prop < 0`` merges levels with share > -prop."""
    cols = list(cols)
    if not cols or prop == 0:  # no level has a share of 0
        return df
    shares = level_shares(df, cols, abs(prop))
    if prop < 0:
        return df.withColumns({c: relabelled(c, None, shares[c].frequent) for c in cols})
    return df.withColumns({
        c: F.col(c) if s.rare <= (1 if keep_single_rare else 0) else relabelled(c, s.frequent)
        for c, s in shares.items()})
