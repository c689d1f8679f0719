"""Effects of every feature: curves over levels, and accumulated effects of categorical features.

A categorical feature has no order of its own.  :func:`level_order` orders its levels by likeness: the distance of two
levels adds up, over all other features, how differently the rows of the two levels are distributed (largest
distance of the distribution functions for numbers, total variation for categories), and classical scaling of the
distances to one dimension gives every level a place.  :func:`ale_levels` accumulates the mean change of the prediction from
each level to the next along that order.

Scale: distances come from grouped counts (partial aggregation; a row counts once per pair of features), no row is paired with
another; predictions of all features are scored in one stacked pass of three variants per row and feature.  Only the levels of
the explained features and their pairwise distances reach the driver: lump rare levels first, as scaling needs
the whole matrix of a feature's levels.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import columns as co
from .categorical import level_dictionary
from .explain import GRID_SIZE, equal_grid, ice, quantile_breaks
from .models import Scorer
from .split import materialize

QUANTILES = 100  # points at which distribution functions are compared

_CURVES = "feature string, feature_val double, feature_level string, y_hat double, type string, id bigint"


def _kinds(df: DataFrame, id_col: str, exclude: Sequence[str], features: Sequence[str] | None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) features: the given ones, or all columns but the key and ``exclude``."""
    skip, numeric = {id_col, *exclude}, set(co.numeric_columns(df))
    names = list(features) if features is not None else [c for c in df.columns if c not in skip]
    return [f for f in names if f in numeric], [f for f in names if f not in numeric]


# ---------------------------------------------------------------- curves over levels

def ice_levels(df: DataFrame, scorer: Scorer, feature: str, levels: Sequence[str] | None = None, id_col: str = "id",
               scale: float = 1.0) -> DataFrame:
    """One curve per row over the levels of a categorical feature (``None``: all that occur).

    ``feature, feature_val (NULL), feature_level, y_hat, type='ice', id``; rows x levels of output, streamed without a shuffle."""
    if levels is None:
        levels = level_dictionary(df, [feature]).get((feature,), [])
    stacked = df.withColumn(feature, F.explode(F.array(*map(F.lit, levels)).cast("array<string>")))
    return scorer(stacked).select(
        F.lit(feature).alias("feature"), F.lit(None).cast("double").alias("feature_val"), F.col(feature).alias("feature_level"),
        (F.col("prediction") / F.lit(float(scale))).alias("y_hat"), F.lit("ice").alias("type"), F.col(id_col).cast("bigint").alias("id"))


def ice_all(df: DataFrame, scorer: Scorer, features: Sequence[str] | None = None, grid_size: int = GRID_SIZE, id_col: str = "id",
            scale: float = 1.0, exclude: Sequence[str] = ()) -> DataFrame:
    """:func:`explain.ice` of every numeric and :func:`ice_levels` of every categorical feature, stacked."""
    numeric, nominal = _kinds(df, id_col, exclude, features)
    levels = level_dictionary(df, nominal)
    parts = [ice(df, scorer, f, equal_grid(df, f, grid_size), id_col=id_col, scale=scale).withColumn(
        "feature_level", F.lit(None).cast("string")) for f in numeric]
    parts += [ice_levels(df, scorer, f, levels.get((f,), []), id_col, scale) for f in nominal]
    out = df.sparkSession.createDataFrame([], _CURVES)
    for part in parts:
        out = out.unionByName(part)
    return out


def pdp_ice_all(df: DataFrame, scorer: Scorer, features: Sequence[str] | None = None, grid_size: int = GRID_SIZE, id_col: str = "id",
                scale: float = 1.0, exclude: Sequence[str] = (), one_pass: bool = True) -> DataFrame:
    """The curves of :func:`ice_all` and their means, stacked under ``type``.  With ``one_pass`` the curves are written once and the
    means read them; without, a cheap scorer runs twice and nothing is written."""
    curves = ice_all(df, scorer, features, grid_size, id_col, scale, exclude)
    if one_pass:
        curves = materialize(curves)
    mean = curves.groupBy("feature", "feature_val", "feature_level").agg(F.avg("y_hat").alias("y_hat")).select(
        "feature", "feature_val", "feature_level", "y_hat", F.lit("pdp").alias("type"), F.lit(None).cast("bigint").alias("id"))
    return curves.unionByName(mean)


# ---------------------------------------------------------------- likeness of levels

def _bin(x: Column, breaks: Sequence[float]) -> Column:
    """Position of the first break that is not below ``x`` (a CASE chain): bins up to k hold what lies at or below break k."""
    chain = F.when(x <= F.lit(breaks[0]), 1)
    for k, b in enumerate(breaks[1:], 2):
        chain = chain.when(x <= F.lit(b), k)
    return F.when(x.isNotNull(), chain.otherwise(len(breaks)))


def _by_level(df: DataFrame, features: Sequence[str], others: dict[str, Column], kind: str) -> DataFrame:
    """(feature, level, other, bin, n): rows of each level of ``features`` per bin of every other column."""
    names = {o: f"_bin_{i}" for i, o in enumerate(others)}
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("level"), F.lit(o).alias("other"), F.col(names[o]).alias("bin"))
                      for f in features for o in others if o != f])
    binned = df.select(*features, *[others[o].cast(kind).alias(n) for o, n in names.items()])
    return (binned.select(F.inline(cells)).where("level is not null and bin is not null")
            .groupBy("feature", "level", "other", "bin").agg(F.count(F.lit(1)).alias("n")))


def level_distances(df: DataFrame, features: Sequence[str] | None = None, others: Sequence[str] | None = None, id_col: str = "id",
                    exclude: Sequence[str] = (), quantiles: int = QUANTILES) -> DataFrame:
    """``feature, level_a, level_b, distance`` for every pair of levels (a before b) of the categorical features.

    Per other feature: for numbers the largest distance of the two levels' distribution functions at the exact quantiles of the whole column, for
    categories half the sum of the differences of shares; added up.  NULLs of a column don't count in it; two levels of which one has no
    value of a column are at distance 1 there."""
    _, nominal = _kinds(df, id_col, exclude, features)
    numeric, categories = _kinds(df, id_col, exclude, others)
    spark = df.sparkSession
    if not nominal:
        return spark.createDataFrame([], "feature string, level_a string, level_b string, distance double")
    levels = df.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("level")) for f in nominal]))).where(
        "level is not null").distinct()
    pairs = levels.withColumnRenamed("level", "level_a").join(levels.withColumnRenamed("level", "level_b"), "feature").where("level_a < level_b")
    parts = [pairs.select("feature", "level_a", "level_b", F.lit(0.0).alias("apart"))]

    def both(frame: DataFrame, on: list[str], value: str) -> DataFrame:
        a = frame.select(*on, F.col("level").alias("level_a"), F.col(value).alias("a"))
        b = frame.select(*on, F.col("level").alias("level_b"), F.col(value).alias("b"))
        return a.join(b, on).where("level_a < level_b")

    def whole(name: str, found: DataFrame, names: Sequence[str]) -> DataFrame:
        """Distance 1 where a pair has nothing in common."""
        wanted = pairs.withColumn("other", F.explode(F.array(*map(F.lit, names)))).where("other <> feature")
        return wanted.join(found, ["feature", "level_a", "level_b", "other"], "left").select(
            "feature", "level_a", "level_b", F.coalesce(name, F.lit(1.0)).alias("apart"))

    if categories:
        # read by the totals and by both sides of the pairs: levels x bins rows, counted once
        counts = materialize(_by_level(df, nominal, {c: F.col(c) for c in categories}, "string"))
        totals = counts.groupBy("feature", "level", "other").agg(F.sum("n").alias("total"))
        shares = counts.join(totals, ["feature", "level", "other"]).select("feature", "level", "other", "bin", (F.col("n") / F.col("total")).alias("p"))
        common = both(shares, ["feature", "other", "bin"], "p").groupBy("feature", "level_a", "level_b", "other").agg(
            (1.0 - F.sum(F.least("a", "b"))).alias("apart"))
        parts.append(whole("apart", common, categories))
    breaks = {c: quantile_breaks(df, c, quantiles) for c in numeric}
    breaks = {c: b for c, b in breaks.items() if b}
    if breaks:
        counts = materialize(_by_level(df, nominal, {c: _bin(F.col(c), b) for c, b in breaks.items()}, "int"))
        cells = counts.groupBy("feature", "level", "other").agg(F.collect_list(F.struct("bin", "n")).alias("cells"), F.sum("n").alias("total"))
        upto = F.transform(F.sequence(F.lit(1), F.lit(max(map(len, breaks.values())))), lambda k: F.aggregate(
            F.filter("cells", lambda c: c["bin"] <= k), F.lit(0).cast("bigint"), lambda s, c: s + c["n"]) / F.col("total"))
        far = both(cells.withColumn("upto", upto), ["feature", "other"], "upto").select(
            "feature", "level_a", "level_b", "other", F.array_max(F.zip_with("a", "b", lambda x, y: F.abs(x - y))).alias("apart"))
        parts.append(whole("apart", far, list(breaks)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("feature", "level_a", "level_b").agg(F.sum("apart").alias("distance"))


def scaled_places(distance: np.ndarray) -> np.ndarray:
    """Classical scaling of a distance matrix to one dimension, turned so that the first item with a place of its own
    lies on the negative side."""
    n = len(distance)
    if n == 0 or not distance.any():
        return np.zeros(n)
    centre = np.eye(n) - 1.0 / n
    values, vectors = np.linalg.eigh(-0.5 * centre @ (distance ** 2) @ centre)
    place = vectors[:, -1] * np.sqrt(max(values[-1], 0.0))
    lead = place[np.abs(place) > 1e-9]
    return -place if len(lead) and lead[0] > 0 else place


def level_order(df: DataFrame, features: Sequence[str] | None = None, others: Sequence[str] | None = None, id_col: str = "id",
                exclude: Sequence[str] = (), quantiles: int = QUANTILES) -> dict[str, list[str]]:
    """The levels of every categorical feature, ordered by their place (equal places by name)."""
    _, nominal = _kinds(df, id_col, exclude, features)
    levels = level_dictionary(df, nominal)
    found: dict[str, list] = {}
    for r in level_distances(df, nominal, others, id_col, exclude, quantiles).collect():
        found.setdefault(r["feature"], []).append(r)
    out = {}
    for f in nominal:
        names = levels.get((f,), [])
        at = {v: i for i, v in enumerate(names)}
        matrix = np.zeros((len(names), len(names)))
        for r in found.get(f, []):
            a, b = at[r["level_a"]], at[r["level_b"]]
            matrix[a, b] = matrix[b, a] = r["distance"]
        place = scaled_places(matrix)
        out[f] = [names[i] for i in sorted(range(len(names)), key=lambda i: (place[i], names[i]))]
    return out


# ---------------------------------------------------------------- accumulated effects of categories

def ale_levels(df: DataFrame, scorer: Scorer, features: Sequence[str] | None = None, orders: dict[str, list[str]] | None = None,
               id_col: str = "id", exclude: Sequence[str] = ()) -> DataFrame:
    """Accumulated local effects of categorical features (``None``: all but the key and ``exclude``).

    Along the order of the levels (:func:`level_order` over all other features unless ``orders`` is given), the step from a level to the next is the
    mean change of the prediction when the rows of either level move over that step.  Steps are accumulated and centred by the
    share of each level.  Returns ``feature, level, position, ale``; rows with a NULL level don't count for that feature."""
    _, nominal = _kinds(df, id_col, exclude, features)
    if orders is None:
        orders = level_order(df, nominal, None, id_col, exclude)
    spark, cols = df.sparkSession, [c for c in df.columns if c != "prediction"]
    used = [f for f in nominal if orders.get(f)]
    if not used:
        return spark.createDataFrame([], "feature string, level string, position int, ale double")
    variants = []
    for f in used:
        names = F.array(*map(F.lit, orders[f])).cast("array<string>")
        place = F.array_position(names, F.col(f)).cast("int")
        for move in (-1, 0, 1):
            variants.append(F.struct(
                F.lit(f).alias("_feature"), place.alias("_place"), F.lit(move).alias("_move"),
                *[(F.get(names, place - 1 + move) if c == f else F.col(c)).alias(c) for c in cols]))
    stacked = df.select(F.inline(F.array(*variants)))
    last = F.element_at(F.create_map(*[F.lit(x) for f in used for x in (f, len(orders[f]))]), F.col("_feature"))
    stacked = stacked.where((F.col("_place") >= 1) & (F.col("_place") + F.col("_move")).between(1, last))
    # step k leads from level k to level k + 1: an own prediction ends the step below and begins the step above
    p, at = F.col("prediction"), F.col("_place")
    steps = F.when(F.col("_move") == 1, F.array(F.struct(at.alias("step"), p.alias("part"), F.lit(0).alias("own")))).when(
        F.col("_move") == -1, F.array(F.struct((at - 1).alias("step"), (-p).alias("part"), F.lit(0).alias("own")))).otherwise(
        F.array(F.struct(at.alias("step"), (-p).alias("part"), F.lit(1).alias("own")), F.struct((at - 1).alias("step"), p.alias("part"), F.lit(2).alias("own"))))
    sums = (scorer(stacked).withColumn("_last", last).select("_feature", "_last", F.inline(steps))
            .groupBy("_feature", "_last", "step").agg(
                F.sum("part").alias("part"), F.sum((F.col("own") == 1).cast("int")).alias("here"),
                F.sum((F.col("own") == 2).cast("int")).alias("above")).collect())
    rows = []
    for f in used:
        n, by = len(orders[f]), {r["step"]: r for r in sums if r["_feature"] == f}
        count = np.array([by[k].here if k in by else 0 for k in range(1, n + 1)], float)
        delta = []
        for k in range(1, n):
            # levels k and k + 1 both move over step k; the sum of their parts has no pairs to match
            both = count[k - 1] + count[k]
            delta.append((by[k].part if k in by else 0.0) / both if both else 0.0)
        effect = np.concatenate(([0.0], np.cumsum(delta)))
        effect -= (effect * count).sum() / count.sum() if count.sum() else 0.0
        rows += [(f, v, k + 1, float(e)) for k, (v, e) in enumerate(zip(orders[f], effect))]
    return spark.createDataFrame(rows, "feature string, level string, position int, ale double")
