"""Sparse one-hot encoding of columns with any number of levels.

The level index is a table: one row per (column, level) with the level's rank within its column.  Rows meet it in one join per
nominal column, which Spark broadcasts only below its own size threshold and otherwise sorts (a hot level is split by AQE's
skew join); the rank then becomes a sparse vector.  No level reaches the driver or the plan, and no column is made per level: only the number of
levels of each column does, so a frame of p nominal columns collects p numbers.

Defined cases: NULL and levels that training did not have are dropped (``unseen='drop'``) or encoded as zeros
(``unseen='zero'``); a column without any training level adds no position, and with ``'drop'`` no row is left; a NULL numeric value becomes NaN;
repeated rows stay; an empty training table gives vectors of the numeric columns alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import categorical as cat
from . import split


def level_index(train: DataFrame, nominal: Sequence[str]) -> DataFrame:
    """``(column, level, rank)``: levels in text order within each column, ranks from 0, without a window over a whole column."""
    levels = cat.level_counts(train, nominal).select("column", "level")
    ids = split.dense_row_id(levels, ["column", "level"], "row_id")
    first = ids.groupBy("column").agg(F.min("row_id").alias("first"))
    return ids.join(first, "column").select("column", "level", (F.col("row_id") - F.col("first")).alias("rank"))


@dataclass
class SparseEncoder:
    """A fitted encoding: the level index, the number of levels of each nominal column, and the numeric columns before them."""

    index: DataFrame
    sizes: dict[str, int]
    nominal: list[str]
    numeric: list[str]

    @classmethod
    def fit(cls, train: DataFrame, nominal: Sequence[str], numeric: Sequence[str] = ()) -> SparseEncoder:
        index = split.materialize(level_index(train, nominal))
        sizes = {r["column"]: int(r["n"]) for r in index.groupBy("column").agg((F.max("rank") + 1).alias("n")).collect()}
        return cls(index, sizes, list(nominal), list(numeric))

    def positions(self) -> DataFrame:
        """``(column, level, position)``: where each level stands in the feature vector."""
        start, at = F.create_map(F.lit(""), F.lit(0)), len(self.numeric)
        for c in self.nominal:
            start = F.map_concat(start, F.create_map(F.lit(c), F.lit(at)))
            at += self.sizes.get(c, 0)
        return self.index.select("column", "level", (F.element_at(start, F.col("column")) + F.col("rank")).alias("position"))

    def transform(self, df: DataFrame, unseen: str = "drop", features_col: str = "features") -> DataFrame:
        """``df`` with the vector of numeric values and level indicators appended."""
        if unseen not in ("drop", "zero"):
            raise ValueError("unseen must be 'drop' or 'zero'")
        out, ranks = df, []
        for i, c in enumerate(self.nominal):
            size, rank, level = self.sizes.get(c, 0), f"_rank_{i}", f"_level_{i}"
            of = self.index.filter(F.col("column") == c).select(F.col("level").alias(level), F.col("rank").cast("double").alias(rank))
            out = out.join(of, F.col(c).cast("string") == F.col(level), "inner" if unseen == "drop" else "left").drop(level)
            if size:
                out = out.withColumn(rank, F.coalesce(F.col(rank), F.lit(float(size))))  # one past the last level: all zeros
                ranks.append((rank, f"_hot_{i}", size))
            else:
                out = out.drop(rank)
        hots = [h for _, h, _ in ranks]
        if ranks:
            spark = df.sparkSession
            largest = spark.range(1).select(*[F.lit(float(n - 1)).alias(r) for r, _, n in ranks])
            hot = OneHotEncoder(inputCols=[r for r, _, _ in ranks], outputCols=hots, handleInvalid="keep", dropLast=True).fit(largest)
            out = hot.transform(out)
        join = VectorAssembler(inputCols=[*self.numeric, *hots], outputCol=features_col, handleInvalid="keep")
        return join.transform(out).drop(*[r for r, _, _ in ranks], *hots)
