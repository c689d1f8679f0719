"""Splitting, resampling, dense row ids and column permutation.

Random draws are replaced by keyed hashes (``md5(key|seed)``): reproducible, free
of shuffles, independent of partitioning and of executor loss, and expressible in
any SQL engine.  Exact-size draws and positions use dense row ids (:func:`dense_row_id`),
built without a single-partition window.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_HEX8 = 16**8


def _cols(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def hash_hex(key: str | Iterable[str], seed: int | str) -> Column:
    """``md5(k1|k2|...|seed)`` as hex text."""
    parts = [F.col(k).cast("string") for k in _cols(key)] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def hash_hex_col(key: str | Iterable[str], seed: Column) -> Column:
    """``md5(k1|...|seed)`` with the seed given as a column (e.g. per repetition)."""
    parts = [F.col(k).cast("string") for k in _cols(key)] + [seed.cast("string")]
    return F.md5(F.concat_ws("|", *parts))


def hash_unit(key: str | Iterable[str], seed: int | str) -> Column:
    """The first 32 bits of the keyed md5 as an integer in [0, 2^32)."""
    return F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("bigint")


def hash_threshold(prop: float) -> str:
    return format(int(prop * _HEX8), "08x")


def split_flag(key: str | Iterable[str], prop: float = 0.8, seed: int | str = 42) -> Column:
    """TRUE for training rows: hash prefix below ``prop`` of the hash range (no shuffle)."""
    return F.substring(hash_hex(key, seed), 1, 8) < F.lit(hash_threshold(prop))


def initial_split(df: DataFrame, key: str | Iterable[str], prop: float = 0.8, seed: int | str = 42,
                  set_col: str = "set") -> DataFrame:
    """Tag each row ``train`` / ``test``.  Pass ``key=[group]`` (e.g. person) for leak-free splits."""
    return df.withColumn(set_col, F.when(split_flag(key, prop, seed), "train").otherwise("test"))


def training(tagged: DataFrame, set_col: str = "set") -> DataFrame:
    return tagged.filter(F.col(set_col) == "train").drop(set_col)


def testing(tagged: DataFrame, set_col: str = "set") -> DataFrame:
    return tagged.filter(F.col(set_col) == "test").drop(set_col)


def split_complement(df: DataFrame, train: DataFrame, key: str | Iterable[str]) -> DataFrame:
    """Rows of ``df`` not in ``train`` (set difference on the key): a left anti join."""
    k = _cols(key)
    return df.join(train.select(*k), on=k, how="left_anti")


def fold_id(key: str | Iterable[str], folds: int = 4, seed: int | str = 4) -> Column:
    """Cross-validation fold in [0, folds) from the keyed hash."""
    return (hash_unit(key, seed) % F.lit(folds)).cast("bigint")


def cv_folds(df: DataFrame, key: str | Iterable[str], folds: int = 4, seed: int | str = 4,
             fold_col: str = "fold") -> DataFrame:
    return df.withColumn(fold_col, fold_id(key, folds, seed))


def dense_row_id(df: DataFrame, order_by: Sequence[str | Column], id_col: str = "row_id",
                 num_partitions: int | None = None) -> DataFrame:
    """Gap-free 1..n ids in ``order_by`` order (see :func:`dense_row_id_counted`)."""
    return dense_row_id_counted(df, order_by, id_col, num_partitions)[0]


def dense_row_id_counted(df: DataFrame, order_by: Sequence[str | Column], id_col: str = "row_id",
                         num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Gap-free 1..n ids in ``order_by`` order, without a global single-partition window.

    1. range-partition on the order and sort within partitions (sampled bounds, so
       partitions are balanced even under skew of other columns);
    2. tag rows with ``monotonically_increasing_id`` (partition index in the upper bits);
    3. checkpoint to the shared checkpoint folder: the tags are now stable even if an
       executor is lost and a stage is recomputed;
    4. count rows per partition (one small aggregate; <= num_partitions rows reach the
       driver) and turn the counts into offsets;
    5. id = offset[partition] + position in partition, a projection.

    Ties in ``order_by`` are broken arbitrarily but consistently (after the checkpoint).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    part = F.shiftright(F.col("_mid"), 33)
    counts = tagged.groupBy(part.alias("p")).count().collect()
    sizes = {int(r["p"]): int(r["count"]) for r in counts}
    if not sizes:
        return tagged.drop("_mid").withColumn(id_col, F.lit(None).cast("bigint")), 0
    offsets, run = [], 0
    for p in range(max(sizes) + 1):
        offsets.append(run)
        run += sizes.get(p, 0)
    before = F.array(*[F.lit(o).cast("bigint") for o in offsets])  # indexed by partition
    pos = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return tagged.withColumn(id_col, (F.get(before, part.cast("int")) + pos + 1).cast("bigint")).drop("_mid"), run


def exact_split(df: DataFrame, key: str | Iterable[str], prop: float = 0.8, seed: int | str = 2,
                set_col: str = "set") -> DataFrame:
    """Exactly ``floor(prop * n)`` training rows: the lowest keyed hashes are drawn.  Keys are unique.

    The cut is found by counting hash prefixes, four digits at a time, descending into the prefix that holds
    it (at most 65,536 counts reach the driver per round); the result is a projection, no row of ``df`` is shuffled.
    """
    h = hash_hex(key, seed)
    hashes = df.select(h.alias("_h"))
    prefix, cut, left = "", "", None
    while len(prefix) < 32:
        inside = hashes.filter(F.col("_h").startswith(prefix)) if prefix else hashes
        counts = sorted((r["p"], int(r["n"])) for r in inside.groupBy(
            F.substring("_h", 1, len(prefix) + 4).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        if left is None:
            left = int(prop * sum(n for _, n in counts))
        deeper = None
        for p, n in counts:
            if left < n:
                deeper = p if left else None
                break
            cut, left = p + "g", left - n  # "g" sorts behind every hash with this prefix
        if deeper is None:
            break
        prefix = deeper
    return df.withColumn(set_col, F.when(h < F.lit(cut), "train").otherwise("test"))


# ---------------------------------------------------------------- keyed bijection

_PRIME = 2147483647  # 2^31 - 1: products of two residues stay within 64 bits
_ROUNDS = 4
_WALK = 64


def bijection_sides(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid with at least ``n`` cells."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def bijection_keys(seed: int | str) -> list[tuple[int, int]]:
    """Multiplier and addend of each round, from the seed alone."""
    out = []
    for k in range(_ROUNDS):
        h = hashlib.md5(f"{seed}:round {k}".encode()).hexdigest()
        out.append((1 + int(h[:12], 16) % (_PRIME - 1), int(h[12:24], 16) % _PRIME))
    return out


def with_permuted_index(df: DataFrame, i: Column, n: int, seeds: Sequence[int | str], which: Column | None = None,
                        out_col: str = "_j") -> DataFrame:
    """``df`` with the place of ``i`` (0 .. n - 1) in a seeded permutation of 0 .. n - 1, by arithmetic alone: nothing is sorted or moved.

    A Feistel network on the cells of a near-square grid: each round adds a keyed function of one coordinate to the other, so every round can be undone.
    The few values that land on a cell beyond ``n`` walk on along their cycle until they are below.  With several
    ``seeds``, ``which`` (from 0) picks the permutation of each row.  Each round is a projection of its own, so no expression is repeated."""
    rows, cols = (F.lit(x).cast("bigint") for x in bijection_sides(n))
    prime = F.lit(_PRIME).cast("bigint")
    pick = F.lit(0) if which is None else which.cast("int")
    keys = [F.array(*[F.struct(*[F.lit(x).cast("bigint").alias(c) for c, x in zip("abcd", (*ks[k], *ks[k + 1]))]) for k in (0, 2)])
            for ks in map(bijection_keys, seeds)]

    def square(t: Column) -> Column:
        return (t * t) % prime

    def turn(v: Column) -> Column:
        """One turn as a single expression, for the few values that walk on."""
        start = F.struct(((v - v % cols) / cols).cast("bigint").alias("l"), (v % cols).alias("r"))

        def two_rounds(at, k):
            left = (at["l"] + square((at["r"] * k["a"] + k["b"]) % prime)) % rows
            return F.struct(left.alias("l"), ((at["r"] + square((left * k["c"] + k["d"]) % prime)) % cols).alias("r"))

        return F.aggregate("_keys", start, two_rounds, lambda at: at["l"] * cols + at["r"])

    names = df.columns
    out = df.withColumn("_v", i.cast("bigint")).withColumn("_keys", F.element_at(F.array(*keys), pick + 1))
    out = out.withColumns({"_l": ((F.col("_v") - F.col("_v") % cols) / cols).cast("bigint"), "_r": F.col("_v") % cols})
    for k in range(_ROUNDS):
        key, (x, y, side) = F.col("_keys")[k // 2], (("_r", "_l", rows), ("_l", "_r", cols))[k % 2]
        a, b = (key["a"], key["b"]) if k % 2 == 0 else (key["c"], key["d"])
        out = out.withColumn("_t", (F.col(x) * a + b) % prime).withColumn(y, (F.col(y) + square(F.col("_t"))) % side)
    out = out.withColumn("_first", F.col("_l") * cols + F.col("_r"))
    spare = math.prod(bijection_sides(n)) - n
    if spare == 0:
        return out.select(*names, F.col("_first").alias(out_col))
    # a cycle has at most ``spare`` cells beyond n; from 4,096 rows on fewer than 1 in 64 values step beyond at a time
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(min(spare, _WALK))), F.col("_first"), lambda v, _: F.when(v < n, v).otherwise(turn(v)))
    out = out.withColumn("_walked", F.when(F.col("_first") < n, F.col("_first")).otherwise(walked))
    lost = F.raise_error(F.lit("a value found no place")).cast("bigint")
    return out.select(*names, F.when(F.col("_walked") < n, F.col("_walked")).otherwise(lost).alias(out_col))


def permute_column(df: DataFrame, column: str, key: str, seed: int | str = 1,
                   out_col: str | None = None) -> DataFrame:
    """A seeded permutation of one column's values across rows.

    Row i (i-th smallest key) receives the value of the row at the place of i in a seeded bijection (:func:`with_permuted_index`): one dense id (one sort, written once), and one equi join
    that moves the values to their rows.
    """
    out_col = out_col or column
    dense, n = dense_row_id_counted(df, [key], id_col="_i")
    rows = with_permuted_index(dense, F.col("_i") - 1, n, [seed])
    values = dense.select((F.col("_i") - 1).alias("_j"), F.col(column).alias("_permuted"))
    joined = rows.join(values, "_j")
    if out_col == column:
        return joined.select(*[F.col("_permuted").alias(c) if c == column else F.col(c) for c in df.columns])
    return joined.select(*df.columns, F.col("_permuted").alias(out_col))


def background_sample(df: DataFrame, key: str, m: int, seed: int | str = 3) -> DataFrame:
    """The ``m`` rows with the lowest keyed hash: a bounded, reproducible sample.

    ``orderBy(...).limit(m)`` plans as TakeOrderedAndProject: each task keeps its own
    top ``m`` and only ``m * partitions`` rows move -- no full sort.
    """
    return df.orderBy(hash_hex(key, seed), F.col(key)).limit(m)


def key_at_position(df: DataFrame, key: str, position: int):
    """The ``position``-th smallest key (1-based), exactly, without a full sort.

    ``orderBy(key).limit(position)`` is a TakeOrderedAndProject: every task keeps its
    own ``position`` smallest keys, so at most ``position x partitions`` keys move.
    """
    rows = df.select(key).orderBy(key).limit(position).collect()
    if len(rows) < position:
        raise IndexError(f"only {len(rows)} rows")
    return rows[-1][key]


def row_at_position(df: DataFrame, key: str, position: int) -> DataFrame:
    """The row at 1-based ``position`` in key order (keys unique)."""
    return df.filter(F.col(key) == F.lit(key_at_position(df, key, position)))


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint to the session's shared checkpoint folder (lineage cut, survives executor loss).

    Used where an operator reads its input many times, so that an expensive
    upstream plan runs once.  Select the columns that are needed first: the whole frame is written.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
