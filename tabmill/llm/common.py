"""Helpers shared by the text operators: written intermediates and connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


ROWS_PER_FILE = 250_000


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once to the shared scratch folder (below ``spark.checkpoint.dir``) and read it
    back: later passes restart from the files, also after an executor is lost.  ``options`` go to the writer."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_fields(df: DataFrame, **fields: T.DataType) -> T.StructType:
    """Schema of ``df`` with the given fields behind it."""
    return T.StructType([*df.schema.fields, *(T.StructField(k, v) for k, v in fields.items())])


def bitmap(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of fixed size (``bits``, a power of two of at least 32,768) that marks the low bits of a long column.

    Built by built-in aggregates; whatever the table's size, at most ``bits / 8`` bytes reach the driver.  It only prunes."""
    bit = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1  # bitmaps count from 1
    rows = (values.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[(r.bucket - 1) * 4096:r.bucket * 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap marks."""
    low = hashes.astype(np.uint64, copy=False) & np.uint64(len(bits) * 8 - 1)
    return (bits[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) with component the smallest node reachable over the undirected ``edges``.

    Every round each node takes the smallest label among its neighbours (a partial
    aggregate, so a hub costs one row per task), then follows its label's own label
    (pointer jump), which shortens chains geometrically.  Each round is written to the
    shared folder; the driver sees one count per round.  Self-loops are allowed;
    null ends are ignored; no edges give an empty frame.
    """
    one = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    both = written(one.unionByName(one.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    files = 1 + both.count() // ROWS_PER_FILE  # the rounds are small next to the edges' source: few files each
    labels = written(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("l"))
                     .select("node", F.least("node", "l").alias("component")).coalesce(files), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("y"), "component"), "y")
                .groupBy(F.col("x").alias("node")).agg(F.min("component").alias("m")))
        lowered = labels.join(near, "node", "left").select(
            "node", F.col("component").alias("before"), F.least("component", "m").alias("l"))
        jump = labels.select(F.col("node").alias("l"), F.col("component").alias("of_label"))
        after = written(lowered.join(jump, "l", "left")
                        .select("node", "before", F.least("l", "of_label").alias("component")).coalesce(files), "labels")
        moved = after.where("component <> before").limit(1).count()
        labels = after.select("node", "component")
        if not moved:
            return labels


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``rows`` documents with a non-null ``label``, drawn by hashed id (one label per id, the largest).
    The drawn ids are the broadcast side; ``rows`` bounds them."""
    given = labels.groupBy(F.col(id_col).alias(id_col)).agg(F.max(label).alias("label")).where(
        F.col("label").isNotNull() & F.col(id_col).isNotNull())
    drawn = given.orderBy(F.xxhash64(F.col(id_col), F.lit(29)), id_col).limit(rows)
    return docs.join(F.broadcast(drawn), id_col)
