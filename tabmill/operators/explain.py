"""Model explanation operators over any Scorer (``DataFrame -> DataFrame + prediction``).

Scale rules followed here:

* every operator scores ONE stacked frame (rows x grid, rows x 2 edges, rows x
  features x repetitions, observations x background x coalitions) -- one pass of the
  model -- and aggregates with partial (map-side) aggregation;
* the only values brought to the driver are bounded by parameters: grid points,
  quantile breaks (<= grid_size + 1), the base loss (a scalar), the background
  sample (``m`` rows), the explained observations;
* windows without a partition key run only on frames of at most grid_size rows.

Given a :class:`stacked.Stacked` scorer, an operator reads each row once for all its learners and returns a ``learner`` column.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import columns as co
from .categorical import level_dictionary
from .models import Scorer
from .split import background_sample, dense_row_id_counted, hash_hex_col, materialize, with_permuted_index
from .stacked import Stacked

# Defaults of the explanation methods.
GRID_SIZE = 20
REPETITIONS = 5
SHAPLEY_SAMPLES = 100
LIME_K = 10


def _by(scorer: Scorer) -> list[str]:
    """Columns that tell the learners of a scorer apart."""
    return ["learner"] if isinstance(scorer, Stacked) else []


def _lits(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


# ---------------------------------------------------------------- PDP / ICE

def equal_grid(df: DataFrame, feature: str, grid_size: int = GRID_SIZE) -> list[float]:
    """``grid_size`` equally spaced points from min to max (one aggregate)."""
    row = df.agg(F.min(feature).alias("lo"), F.max(feature).alias("hi")).first()
    if row["lo"] is None:
        return []
    lo, hi = float(row["lo"]), float(row["hi"])
    if grid_size == 1 or hi == lo:
        return [lo]
    step = (hi - lo) / (grid_size - 1)
    return [lo + i * step for i in range(grid_size)]


def ice(df: DataFrame, scorer: Scorer, feature: str, grid: Sequence[float] | None = None,
        grid_size: int = GRID_SIZE, id_col: str = "id", scale: float = 1.0) -> DataFrame:
    """One curve per row: every row scored at every grid value of ``feature``.

    ``feature, feature_val, y_hat, type='ice', id``.  Output size = rows x grid.
    """
    grid = list(grid) if grid is not None else equal_grid(df, feature, grid_size)
    if grid and _stacked_over(scorer, feature):
        return scorer.curves(df, feature, grid, id_col).select(
            "learner", F.lit(feature).alias("feature"), "feature_val", (F.col("prediction") / F.lit(float(scale))).alias("y_hat"),
            F.lit("ice").alias("type"), "id")
    if not grid:
        grid_col = F.array().cast("array<double>")
    else:
        grid_col = _lits(grid)
    stacked = df.withColumn(feature, F.explode(grid_col))
    scored = scorer(stacked)
    return scored.select(
        *_by(scorer), F.lit(feature).alias("feature"), F.col(feature).cast("double").alias("feature_val"),
        (F.col("prediction") / F.lit(float(scale))).alias("y_hat"), F.lit("ice").alias("type"),
        F.col(id_col).cast("bigint").alias("id"))


def _stacked_over(scorer: Scorer, feature: str) -> bool:
    """Whether points of a number can be scored without a row of their own."""
    return isinstance(scorer, Stacked) and feature in scorer.numeric


def pdp(df: DataFrame, scorer: Scorer, feature: str, grid: Sequence[float] | None = None,
        grid_size: int = GRID_SIZE, id_col: str = "id", scale: float = 1.0) -> DataFrame:
    """Mean prediction per grid value (partial aggregation: grid-sized shuffle)."""
    grid = list(grid) if grid is not None else equal_grid(df, feature, grid_size)
    if grid and _stacked_over(scorer, feature):
        return scorer.curve_means(df, feature, grid).select(
            "learner", F.lit(feature).alias("feature"), "feature_val", (F.col("prediction") / F.lit(float(scale))).alias("y_hat"),
            F.lit("pdp").alias("type"), F.lit(None).cast("bigint").alias("id"))
    return _mean_curve(ice(df, scorer, feature, grid, grid_size, id_col, scale), _by(scorer))


def _mean_curve(curves: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curves.groupBy(*by, "feature", "feature_val").agg(F.avg("y_hat").alias("y_hat")).select(
        *by, "feature", "feature_val", "y_hat", F.lit("pdp").alias("type"), F.lit(None).cast("bigint").alias("id"))


def pdp_ice(df: DataFrame, scorer: Scorer, feature: str, grid: Sequence[float] | None = None,
            grid_size: int = GRID_SIZE, id_col: str = "id", scale: float = 1.0, one_pass: bool = True) -> DataFrame:
    """ICE curves and the PDP stacked under ``type``.

    ``one_pass=True``: score rows x grid ONCE into a checkpoint of the ICE rows (they are
    the result anyway) and aggregate the PDP from it -- for expensive scorers.
    ``one_pass=False``: ICE rows stream straight to the output and the PDP is a
    separate partially-aggregated pass, i.e. the model scores twice and nothing is
    written -- for cheap scorers (a formula, stacked learners).  Rows that share an id keep a curve each.
    """
    grid = list(grid) if grid is not None else equal_grid(df, feature, grid_size)
    curves = ice(df, scorer, feature, grid, grid_size, id_col, scale)
    if grid and _stacked_over(scorer, feature):
        return curves.unionByName(pdp(df, scorer, feature, grid, grid_size, id_col, scale))
    if one_pass:
        curves = materialize(curves)
    return curves.unionByName(_mean_curve(curves, _by(scorer)))


def pdp_all(df: DataFrame, scorer: Scorer, features: Sequence[str] | None = None, grid_size: int = GRID_SIZE,
            id_col: str = "id", exclude: Sequence[str] = ()) -> DataFrame:
    """Mean prediction over every feature's grid: equally spaced points of numeric features, the levels of
    categorical ones.  ``features=None`` explains every column but the key and ``exclude``.

    The rows of all features' grids are stacked and scored in one pass; a grid is a literal array, exploded per row
    (a result row per grid value, so it is as large as the result).  Returns ``feature, feature_val, feature_level, y_hat`` (value or level is NULL).
    """
    skip = {id_col, *exclude}
    features = list(features) if features is not None else [c for c in df.columns if c not in skip]
    numeric = set(co.numeric_columns(df))
    cols = [c for c in df.columns if c not in skip]
    lohi = [f for f in features if f in numeric]
    span = df.agg(*[F.min(f).cast("double").alias(f"lo_{f}") for f in lohi],
                  *[F.max(f).cast("double").alias(f"hi_{f}") for f in lohi]).first() if lohi else None
    levels = {(f,): [] for f in features} | level_dictionary(df, [f for f in features if f not in numeric])
    parts = []
    for f in features:
        if f in numeric:
            lo, hi = span[f"lo_{f}"], span[f"hi_{f}"]
            if lo is None:
                continue
            n = 1 if hi == lo else grid_size
            step = (hi - lo) / (grid_size - 1) if n > 1 else 0.0
            rows = df.select(*[c for c in cols if c != f], F.explode(_lits([lo + i * step for i in range(n)])).alias(f))
            value, level = F.col(f), F.lit(None).cast("string")
        else:
            rows = df.select(*[c for c in cols if c != f], F.explode(F.array(*map(F.lit, levels[(f,)])).cast("array<string>")).alias(f))
            value, level = F.lit(None).cast("double"), F.col(f)
        parts.append(rows.select(F.lit(f).alias("_feature"), value.alias("_value"), level.alias("_level"),
                                 *[F.col(c).cast("double" if c in numeric else df.schema[c].dataType).alias(c) for c in cols]))
    if not parts:
        return df.sparkSession.createDataFrame([], "feature string, feature_val double, feature_level string, y_hat double")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return scorer(stacked).groupBy(F.col("_feature").alias("feature"), F.col("_value").alias("feature_val"),
                                   F.col("_level").alias("feature_level")).agg(F.avg("prediction").alias("y_hat"))


# ---------------------------------------------------------------- ALE

def quantile_breaks(df: DataFrame, feature: str, grid_size: int = GRID_SIZE) -> list[float]:
    """Distinct exact quantiles (inverse empirical CDF) at k / grid_size, k = 0..grid_size.

    Exact and distributed: values are counted first (partial aggregation, so a hot value is one row), the
    distinct values are range-partitioned and their counts accumulated per partition; only partition totals and
    the <= grid_size + 1 values at the wanted ranks reach the driver.
    """
    spark = df.sparkSession
    counts = df.filter(F.col(feature).isNotNull()).groupBy(F.col(feature).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(counts.repartitionByRange(parts, "_v").withColumn("_p", F.spark_partition_id()))
    totals = {r["_p"]: int(r["n"]) for r in ranged.groupBy("_p").agg(F.sum("_n").alias("n")).collect()}
    if not totals:
        return []
    before, n = [], 0
    for p in range(max(totals) + 1):
        before.append(n)
        n += totals.get(p, 0)
    ranks = sorted({max(1, -(-(n * k) // grid_size)) for k in range(grid_size + 1)})
    offset = F.get(F.array(*[F.lit(x).cast("bigint") for x in before]), F.col("_p"))
    upto = (F.sum("_n").over(Window.partitionBy("_p").orderBy("_v")) + offset).alias("_upto")
    wanted = F.array(*[F.lit(r).cast("bigint") for r in ranks])
    rows = ranged.select("_v", "_n", upto).filter(F.exists(
        wanted, lambda r: (r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_n")))).select("_v").collect()
    return sorted(float(r["_v"]) for r in rows)


def interval_index(x: Column, breaks: Sequence[float]) -> Column:
    """1-based interval of ``x`` for right-closed intervals (b[k-1], b[k]]; b[0] falls in interval 1.

    A CASE chain over <= grid_size breaks: stays inside generated code.
    """
    expr = F.when(x <= F.lit(breaks[1]), F.lit(1))
    for k in range(2, len(breaks)):
        expr = expr.when(x <= F.lit(breaks[k]), F.lit(k))
    return expr.otherwise(F.lit(len(breaks) - 1))


def ale(df: DataFrame, scorer: Scorer, feature: str, grid_size: int = GRID_SIZE) -> DataFrame:
    """Accumulated local effects of a numeric feature, centred by the count-weighted mean.

    Each row is scored at both edges of its interval (rows x 2, one scoring pass); the
    mean local difference per interval is (sum at upper edge - sum at lower edge) / n,
    so rows never need pairing.  Accumulation and centring run on <= grid_size rows.
    Returns ``feature, feature_val, ale`` at every break.
    """
    by = _by(scorer)
    breaks = quantile_breaks(df, feature, grid_size)
    if len(breaks) < 2:
        return df.sparkSession.createDataFrame([], "".join(f"{c} string, " for c in by) + "feature string, feature_val double, ale double")
    b = _lits(breaks)
    known = df.filter(F.col(feature).isNotNull())
    if _stacked_over(scorer, feature):
        per = scorer.edge_sums(known, feature, interval_index(F.col(feature), breaks), breaks).select(
            *by, "_k", (F.col("total") / F.col("n")).alias("delta"), "n")
    else:
        rows = known.withColumn("_k", interval_index(F.col(feature), breaks))
        two = rows.withColumn("_hi", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn(
            feature, F.when(F.col("_hi"), F.element_at(b, F.col("_k") + 1)).otherwise(F.element_at(b, F.col("_k"))))
        scored = scorer(two)
        p = F.col("prediction")
        per = scored.groupBy(*by, "_k").agg(
            (F.sum(F.when(F.col("_hi"), p).otherwise(-p)) / F.sum(F.col("_hi").cast("int"))).alias("delta"),
            F.sum(F.col("_hi").cast("int")).alias("n"))
    every = Window.partitionBy(*by)
    order = every.orderBy("_k")
    acc = per.withColumn("f_hi", F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    acc = acc.withColumn("f_lo", F.coalesce(F.lag("f_hi").over(order), F.lit(0.0)))
    centre = F.sum(F.col("n") * (F.col("f_lo") + F.col("f_hi")) / 2.0).over(every) / F.sum("n").over(every)
    acc = acc.withColumn("_c", centre)
    pts = F.when(F.col("_k") == 1, F.array(
        F.struct(F.element_at(b, 1).alias("feature_val"), (F.col("f_lo") - F.col("_c")).alias("ale")),
        F.struct(F.element_at(b, 2).alias("feature_val"), (F.col("f_hi") - F.col("_c")).alias("ale")),
    )).otherwise(F.array(
        F.struct(F.element_at(b, F.col("_k") + 1).alias("feature_val"), (F.col("f_hi") - F.col("_c")).alias("ale"))))
    return acc.select(*by, F.lit(feature).alias("feature"), F.inline(pts))


def ale_all(df: DataFrame, scorer: Scorer, features: Sequence[str] | None = None, grid_size: int = GRID_SIZE,
            id_col: str = "id", exclude: Sequence[str] = ()) -> DataFrame:
    """:func:`ale` of every numeric feature (``None``: all but the key and ``exclude``), stacked."""
    skip = {id_col, *exclude}
    features = list(features) if features is not None else [c for c in co.numeric_columns(df) if c not in skip]
    out = df.sparkSession.createDataFrame([], "feature string, feature_val double, ale double")
    for f in features:
        out = out.unionByName(ale(df, scorer, f, grid_size))
    return out


# ---------------------------------------------------------------- permutation importance

def indexed_rows(df: DataFrame, key: str = "id") -> tuple[DataFrame, int]:
    """(``df`` with dense ids ``_i`` from 1 in key order, number of rows): one sort, written once, for all repetitions and models."""
    return dense_row_id_counted(df, [key], "_i")


def permutation_importance(df: DataFrame, scorer: Scorer, target: str, features: Sequence[str], key: str = "id",
                           repetitions: int = REPETITIONS, seed: int = 1, top: int | None = 20,
                           indexed: tuple[DataFrame, int] | None = None) -> DataFrame:
    """MAE-based permutation importance (ratio to the unpermuted error) per feature.

    Each row yields one variant per feature and repetition, with that feature's value
    taken from its donor, the row at the place of its dense id in a seeded bijection (:func:`split.with_permuted_index`; pass ``indexed``, made by :func:`indexed_rows`, to
    reuse the ids across models); one join on the donor's id moves the donors.  All features x repetitions are scored in one pass and reduced with one
    grouped aggregate; quantiles over repetitions are exact on groups of
    ``repetitions`` values.  Returns ``feature, importance_05, importance,
    importance_95, permutation_error, display_order`` (top ``top`` by importance,
    ties kept).
    """
    features, by = list(features), _by(scorer)
    seeds = [f"{seed}:{r}" for r in range(repetitions)]
    if by:
        errs = _stacked_errors(df, scorer, target, features, key, seeds)
        base = F.max(F.when(F.col("_feature").isNull() & (F.col("_rep") == 0), F.col("err"))).over(Window.partitionBy(*by))
        errs = errs.withColumn("_base", base).where(F.col("_feature").isNotNull())
        ratio = F.try_divide(F.col("err"), F.col("_base"))
    else:
        df = df.select(key, target, *features)
        base_loss = scorer(df).agg(F.avg(F.abs(F.col(target) - F.col("prediction")))).first()[0]
        dense, n = indexed if indexed is not None else indexed_rows(df, key)
        donors = dense.select((F.col("_i") - 1).alias("_j"), *[F.col(f).alias(f"_d_{i}") for i, f in enumerate(features)])
        reps = dense.select("_i", key, target, *features, F.explode(F.sequence(F.lit(0), F.lit(repetitions - 1))).alias("_rep"))
        placed = with_permuted_index(reps, F.col("_i") - 1, n, seeds, F.col("_rep"))
        wide = placed.join(donors, "_j")
        variants = F.array(*[
            F.struct(F.lit(f).alias("_feature"),
                     *[(F.col(f"_d_{j}") if g == f else F.col(g)).alias(g) for j, g in enumerate(features)])
            for f in features])
        long = wide.select("_rep", key, target, F.inline(variants))
        scored = scorer(long)
        errs = scored.groupBy("_feature", "_rep").agg(F.avg(F.abs(F.col(target) - F.col("prediction"))).alias("err"))
        ratio = F.try_divide(F.col("err"), F.lit(float(base_loss)))
    summary = errs.groupBy(*by, F.col("_feature").alias("feature")).agg(
        F.percentile(ratio, [0.05, 0.5, 0.95]).alias("_q"), F.percentile("err", 0.5).alias("permutation_error"))
    out = summary.select(*by, "feature", F.col("_q")[0].alias("importance_05"), F.col("_q")[1].alias("importance"),
                         F.col("_q")[2].alias("importance_95"), "permutation_error")
    return top_features(out, top, group=by)


def _stacked_errors(df: DataFrame, scorer: Stacked, target: str, features: Sequence[str], key: str, seeds: Sequence[str]) -> DataFrame:
    """Errors of every learner from one join: rows and donors move as numbers, and a task exchanges one feature after the other."""
    dense, n = indexed_rows(df.select(key, F.col(target).cast("double").alias("_y"), *scorer.packed("_c")), key)
    own = scorer.packed_names("_c")
    donors = dense.select((F.col("_i") - 1).alias("_j"), *[F.col(c).alias(d) for c, d in zip(own, scorer.packed_names("_d"))])
    reps = dense.where(F.col("_y").isNotNull()).select("_i", "_y", *own, F.explode(F.sequence(F.lit(0), F.lit(len(seeds) - 1))).alias("_rep"))
    placed = with_permuted_index(reps, F.col("_i") - 1, n, seeds, F.col("_rep"))
    pairs = placed.drop("_i").join(donors, "_j").drop("_j")
    return scorer.swap_errors(pairs, features, len(seeds))


def grouped_importance(df: DataFrame, classify: Scorer, target: str, features: Sequence[str], group: str, key: str = "id",
                       repetitions: int = REPETITIONS, seed: int = 1) -> DataFrame:
    """Permutation importance of a classifier by the share of wrong labels, permuting within each value of ``group``.

    ``classify`` appends ``estimate``.  One dense id in (group, key) order serves all groups and repetitions; each group's rows are moved by a
    bijection of its own size.  The ratio to the unpermuted share is NULL where that is 0.  Returns ``group, feature, importance_05,
    importance, importance_95, permutation_error``; groups are few (a task column), rows with a NULL group are left out.
    """
    features = list(features)
    df = df.select(key, group, target, *features).where(F.col(group).isNotNull())
    dense, _ = dense_row_id_counted(df, [group, key], "_i")
    sizes = {r[0]: (r["first"], r["n"]) for r in dense.groupBy(group).agg(F.min("_i").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
    wrong = F.coalesce((F.col(target) != F.col("estimate")).cast("int"), F.lit(1))
    base = classify(df).groupBy(group).agg(F.avg(wrong).alias("_base"))
    reps = dense.withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(repetitions - 1))))
    placed = None
    for g in sorted(sizes, key=str):
        first, n = sizes[g]
        part = with_permuted_index(reps.where(F.col(group) == F.lit(g)), F.col("_i") - first, n, [f"{seed}:{g}:{r}" for r in range(repetitions)],
                                   F.col("_rep")).withColumn("_j", F.col("_j") + first)
        placed = part if placed is None else placed.unionByName(part)
    if placed is None:
        return df.sparkSession.createDataFrame([], f"`{group}` string, feature string, importance_05 double, importance double, "
                                               "importance_95 double, permutation_error double")
    donors = dense.select(F.col("_i").alias("_j"), *[F.col(f).alias(f"_d_{i}") for i, f in enumerate(features)])
    wide = placed.join(donors, "_j")
    variants = F.array(*[F.struct(F.lit(f).alias("_feature"), *[(F.col(f"_d_{j}") if g == f else F.col(g)).alias(g) for j, g in enumerate(features)])
                         for f in features])
    scored = classify(wide.select("_rep", key, group, target, F.inline(variants)))
    errors = scored.groupBy(group, "_feature", "_rep").agg(F.avg(wrong).alias("_err")).join(base, group)
    ratio = F.try_divide(F.col("_err"), F.col("_base"))
    out = errors.groupBy(group, F.col("_feature").alias("feature")).agg(
        F.percentile(ratio, [0.05, 0.5, 0.95]).alias("_q"), F.percentile("_err", 0.5).alias("permutation_error"))
    return out.select(group, "feature", F.col("_q")[0].alias("importance_05"), F.col("_q")[1].alias("importance"),
                      F.col("_q")[2].alias("importance_95"), "permutation_error")


def top_features(imp: DataFrame, top: int | None = 20, by: str = "importance", digits: int | None = 6, group: Sequence[str] = ()) -> DataFrame:
    """Top ``top`` rows by ``by`` with ties kept (rank), plus a display order (small frame), within each value of ``group``."""
    if digits is not None:
        imp = imp.select(*[F.round(c, digits).alias(c) if c.startswith("importance") else F.col(c)
                           for c in imp.columns])
    w = Window.partitionBy(*group).orderBy(F.desc(by), F.asc("feature"))
    out = imp.withColumn("display_order", F.row_number().over(w).cast("bigint"))
    if top is not None:
        out = out.withColumn("_rank", F.rank().over(Window.partitionBy(*group).orderBy(F.desc(by)))).filter(
            F.col("_rank") <= top).drop("_rank")
    return out


# ---------------------------------------------------------------- Shapley (batch)

def shapley(df: DataFrame, scorer: Scorer, features: Sequence[str], observations: DataFrame, key: str = "id",
            m: int = SHAPLEY_SAMPLES, seed: int = 3) -> DataFrame:
    """Sampling Shapley values for a batch of observations.

    ``m`` background rows (lowest keyed hash over the whole table, bounded) each come
    with a seeded feature order; along that order the coalition grows one feature at
    a time (p + 1 scored rows per observation and sample), and each feature's
    marginal contribution is the change in prediction when it joins.  Returns
    ``id, feature, feature_value, phi, phi_var`` (mean and sample variance over
    samples); per observation, the phis sum to f(x) minus the mean background f.
    """
    features = list(features)
    p = len(features)
    types = {f.name: f.dataType for f in df.schema.fields}
    bg_rows = background_sample(df, key, m, seed).select(*features).collect()
    bg = F.array(*[
        F.struct(F.lit(s).alias("_s"), *[F.lit(r[f]).cast(types[f]).alias(f) for f in features])
        for s, r in enumerate(bg_rows)])
    x = observations.select(F.col(key).alias("_obs"), *[F.col(f).alias(f"_x_{i}") for i, f in enumerate(features)])
    x = x.withColumn("_z", F.explode(bg))
    order = F.array_sort(F.array(*[
        F.struct(F.md5(F.concat_ws("|", F.col("_z._s").cast("string"), F.lit(f), F.lit(str(seed)))).alias("h"),
                 F.lit(f).alias("f")) for f in features]))
    x = x.withColumn("_order", F.transform(order, lambda e: e["f"]))
    x = x.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(p))))
    chain = x.select(
        "_obs", F.col("_z._s").alias("_s"), "_t",
        F.when(F.col("_t") > 0, F.element_at("_order", F.greatest(F.col("_t"), F.lit(1)))).alias("_joined"),
        *[F.when(F.array_position("_order", F.lit(f)) <= F.col("_t"), F.col(f"_x_{i}"))
          .otherwise(F.col(f"_z.{f}")).alias(f) for i, f in enumerate(features)])
    scored = scorer(chain)
    by = _by(scorer)
    w = Window.partitionBy(*by, "_obs", "_s").orderBy("_t")
    contrib = scored.select(*by, "_obs", "_joined", (F.col("prediction") - F.lag("prediction").over(w)).alias("c")) \
        .filter(F.col("_joined").isNotNull())
    phi = contrib.groupBy(*by, "_obs", "_joined").agg(F.avg("c").alias("phi"), F.var_samp("c").alias("phi_var"))
    values = observations.select(F.col(key).alias("_obs"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("_joined"), F.concat_ws("=", F.lit(f), F.col(f).cast("string")).alias("feature_value"))
        for f in features])))
    return phi.join(values, ["_obs", "_joined"]).select(
        *by, F.col("_obs").cast("bigint").alias("id"), F.col("_joined").alias("feature"), "feature_value", "phi", "phi_var")


# ---------------------------------------------------------------- LIME (batch)

def lasso_path(R: np.ndarray, r: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """(coefficients, penalty) of the lasso in standardized covariance form where its path would take in feature ``k + 1``.

    The solution is linear in the penalty between knots, so the path is followed exactly from knot to knot: a feature joins when its
    residual correlation reaches the penalty, and leaves when its coefficient returns to zero.  Without a feature ``k + 1`` the path
    ends at penalty 0, the least-squares fit of the features taken in.  A feature that repeats active ones never joins.
    """
    p = len(r)
    beta, c = np.zeros(p), np.array(r, float)
    penalty = top = float(np.max(np.abs(c))) if p else 0.0
    if k < 1 or top == 0.0:
        return beta, penalty
    active, left = [int(np.argmax(np.abs(c)))], -1
    while True:
        signs = np.sign(c[active])
        own = np.linalg.solve(R[np.ix_(active, active)], np.column_stack((signs, R[active])))
        d = own[:, 0]
        a = R[:, active] @ d
        new = np.diag(R) - np.sum(R[active] * own[:, 1:], axis=0)  # variance that the active features leave
        step, event = penalty, None
        for j in range(p):
            if j in active or new[j] <= 1e-9:
                continue
            back = left >= 0 and abs(R[j, left]) > 1.0 - 1e-9  # the feature that has just left, or its repeat
            for side in (1.0, -1.0):  # where the residual correlation of j meets the falling penalty
                rate = 1.0 - side * a[j]
                at = max(penalty - side * c[j], 0.0) / rate if rate > 0.0 else np.inf
                if at < step and not (back and at <= 1e-9 * top):
                    step, event = at, (j, True)
        for i, v in zip(active, d):
            if beta[i] * v < 0.0 and -beta[i] / v < step:
                step, event = -beta[i] / v, (i, False)
        beta[active] += step * d
        c -= step * a
        penalty -= step
        if event is None:
            return beta, 0.0
        j, joins = event
        if not joins:
            beta[j] = 0.0
            active.remove(j)
            left = j
        elif len(active) == k:
            return beta, penalty
        else:
            active.append(j)
            c[j] = np.copysign(penalty, c[j])
            left = -1


def lime_gram(df: DataFrame, scorer: Scorer, features: Sequence[str], observations: DataFrame, key: str = "id") -> DataFrame:
    """Weighted sums of the local surrogates: ``(id, i, j, value)`` for ``i <= j``.

    Per observation the design is 1, one column per feature (numeric: its value; categorical: 1 where it equals the observation's)
    and the model's prediction; the weight of a row is ``1 - Gower distance`` to the observation.  Rows, and observations, that
    miss one of the features are left out (:func:`incomplete_rows` counts them).  Each task reads a row once, weights it against
    all observations and sends one partial sum per cell; Spark adds them up.
    """
    features = list(features)
    numeric = co.numeric_columns(df)
    is_num = [f in numeric for f in features]
    base = df.select(key, *features).na.drop("any", subset=features)
    obs = [(int(r[key]), [r[f] for f in features])
           for r in observations.select(key, *features).na.drop("any", subset=features).collect()]
    num = [f for f, x in zip(features, is_num) if x]
    rng = base.agg(*[(F.max(f) - F.min(f)).cast("double").alias(f) for f in num]).first() if num else None
    width = [(rng[f] or 1.0) if x else 1.0 for f, x in zip(features, is_num)]
    by = _by(scorer)
    names = scorer.names if by else [None]
    scored = scorer.appended(df.na.drop("any", subset=features), "_ys") if by else scorer(base)
    scored = scored.select(
        *[F.col(f).cast("double" if x else "string").alias(f"v{i}") for i, (f, x) in enumerate(zip(features, is_num))],
        *[(F.col("_ys")[m] if by else F.col("prediction").cast("double")).alias(f"y{m}") for m in range(len(names))])
    q = len(features)
    cells = [(i, j) for i in range(q + 2) for j in range(i, q + 2)]

    def partial_sums(batches):
        total = np.zeros((len(obs), q + 1 + len(names), q + 1 + len(names)))
        for pdf in batches:
            if not len(pdf):
                continue
            cols, ys = [pdf[f"v{i}"].to_numpy() for i in range(q)], [pdf[f"y{m}"].to_numpy() for m in range(len(names))]
            for o, (_, at) in enumerate(obs):
                z = np.empty((len(pdf), q + 1 + len(names)))
                z[:, 0], z[:, q + 1:] = 1.0, np.column_stack(ys)
                far = np.zeros(len(pdf))
                for i in range(q):
                    if is_num[i]:
                        z[:, i + 1] = cols[i]
                        far += np.abs(cols[i] - float(at[i])) / width[i]
                    else:
                        z[:, i + 1] = same = (cols[i] == str(at[i])).astype(float)
                        far += 1.0 - same
                total[o] += (z * (1.0 - far / q)[:, None]).T @ z
        for o, (ident, _) in enumerate(obs):
            for m, name in enumerate(names):
                own = [*range(q + 1), q + 1 + m]  # the design and this learner's predictions
                yield pd.DataFrame({**({"learner": name} if by else {}), "id": ident, "i": [i for i, _ in cells], "j": [j for _, j in cells],
                                    "value": [total[o, own[i], own[j]] for i, j in cells]})

    parts = scored.mapInPandas(partial_sums, "".join(f"{c} string, " for c in by) + "id bigint, i int, j int, value double")
    return parts.groupBy(*by, "id", "i", "j").agg(F.sum("value").alias("value"))


def incomplete_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(n_rows, n_incomplete)``: rows in all, and those that miss one of ``features`` (left out by LIME)."""
    missing = F.lit(False)
    for f in features:
        missing = missing | F.col(f).isNull()
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                  F.coalesce(F.sum(missing.cast("bigint")), F.lit(0)).cast("bigint").alias("n_incomplete"))


def lime(df: DataFrame, scorer: Scorer, features: Sequence[str], observations: DataFrame, key: str = "id",
         k: int = LIME_K) -> DataFrame:
    """Local surrogate (weighted sparse linear model) for a batch of observations.

    The weighted least-squares problem comes from :func:`lime_gram`; per observation, its (features + 2)^2 cells give the exact lasso
    path (:func:`lasso_path`) to at most ``k`` features.  Returns ``id, feature, feature_value, beta, effect``.
    """
    features = list(features)
    is_num = [f in co.numeric_columns(df) for f in features]
    q = len(features)
    values = {int(r[key]): [r[f] for f in features]
              for r in observations.select(key, *features).na.drop("any", subset=features).collect()}
    path = lasso_path

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        obs = int(pdf["id"].iloc[0])
        m = np.zeros((q + 2, q + 2))
        m[pdf["i"], pdf["j"]] = pdf["value"]
        m[pdf["j"], pdf["i"]] = pdf["value"]
        out = []
        if m[0, 0] > 0:
            mu = m[0, 1:] / m[0, 0]
            c = m[1:, 1:] / m[0, 0] - np.outer(mu, mu)
            sd = np.sqrt(np.clip(np.diag(c)[:q], 0, None))
            live = sd > 1e-12
            beta = np.zeros(q)
            if live.any():
                r = c[:q, :q][np.ix_(live, live)] / np.outer(sd[live], sd[live])
                beta[live] = path(r, c[:q, q][live] / sd[live], k)[0] / sd[live]
            for f, x, v, b in zip(features, is_num, values[obs], beta):
                if b != 0.0:
                    out.append((obs, f, f"{f}={v}", float(b), float(b * (float(v) if x else 1.0))))
        found = pd.DataFrame(out, columns=["id", "feature", "feature_value", "beta", "effect"])
        return found.assign(learner=pdf["learner"].iloc[0])[["learner", *found.columns]] if by else found

    by = _by(scorer)
    return lime_gram(df, scorer, features, observations, key).groupBy(*by, "id").applyInPandas(
        solve, "".join(f"{c} string, " for c in by) + "id bigint, feature string, feature_value string, beta double, effect double")
