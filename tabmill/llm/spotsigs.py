"""Document fingerprints by SpotSigs.

A spot is a common word (anchor) with the chain of the next ``CHAIN`` content words; the set of a text's hashed spots is its
fingerprint.  Texts without any spot fall back to the chains that start at every content word, texts with too few words to one hash of the text, so
that only the text without any character has an empty set.  Sets are compared by Jaccard; near-duplicate search partitions sets by length, meets them on a
length-derived prefix, and drops pairs whose lengths alone rule the threshold out.

Built-in functions only: with the anchors' positions p_0 < p_1 < ..., anchor k has p_k - k content words before it, so its
chain is a slice of the content words.

Defined cases: null text counts as empty; two empty sets are alike (1), an empty and another are not (0); equal texts have equal
fingerprints; repeated rows are ordered by (id, text) and each has a next row; null ids come last; a single row is its own next; an empty
table gives an empty result; a table's other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHAIN = 2
BUCKET_ROWS = 1500  # rows of one range of ids, about
MAX_BUCKETS = 4096

# Common words of English, French, German and Spanish.
ANCHORS = sorted(set("""
the of and to in a is that it for on was as with be by are this at from
le la les de des du un une et en que qui dans pour sur par est pas au avec il elle ce
der die das und den von zu mit ist dem ein eine nicht auf für im sich als es auch
el los las y por con para del se no su al lo como
""".split()))


def fingerprints(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``df`` with the sorted distinct spot hashes (32 bits) of a text column.  Every step is a column of its own, so that
    nothing is computed twice."""
    w, c, a = (f"__{x}_{out_col}" for x in "wca")
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = df.withColumn(w, F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != ""))
    out = out.withColumn(c, F.filter(w, lambda x: ~x.isin(ANCHORS)))
    at = F.filter(F.transform(w, lambda x, i: F.when(x.isin(ANCHORS), i)), lambda i: i.isNotNull())
    out = out.withColumn(a, F.filter(F.transform(at, lambda p, k: F.struct(p.alias("p"), (p - k).alias("n"))),
                                     lambda s: s["n"] + CHAIN <= F.size(c)))

    def low(h: Column) -> Column:
        return h.bitwiseAND(F.lit(0xFFFFFFFF))

    spots = F.transform(a, lambda s: low(F.xxhash64(F.get(w, s["p"]), *[F.get(c, s["n"] + j) for j in range(CHAIN)])))
    chains = F.transform(F.sequence(F.lit(0), F.size(c) - CHAIN), lambda i: low(F.xxhash64(*[F.get(c, i + j) for j in range(CHAIN)])))
    whole = F.when(text != "", F.array(low(F.xxhash64(text)))).otherwise(F.array().cast("array<bigint>"))
    one = F.when(F.size(a) > 0, spots).when(F.size(c) >= CHAIN, chains).otherwise(whole)
    return out.withColumn(out_col, one).withColumn(out_col, F.array_sort(F.array_distinct(out_col))).drop(w, c, a)


def as_text(spots: Column) -> Column:
    """The fingerprint as text: hexadecimal spots in order, joined."""
    return F.concat_ws("", F.transform(spots, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")))


def likeness(a: Column, b: Column, digits: int = 6) -> Column:
    """Jaccard likeness of two sets without repeats."""
    both = F.size(F.array_intersect(a, b))
    size = F.size(a) + F.size(b) - both
    return F.when(size == 0, F.lit(1.0)).otherwise(F.round(both / size, digits))


def ranged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """Rows (id, text, bucket, copy) and the window in which ``lead`` gives the next row by descending id; after the last row
    comes the first.  Rows with copy = 1 only serve as neighbours.

    Rows are dealt into ranges of ids whose borders are quantiles over all rows (at most ``MAX_BUCKETS`` numbers).  Each range also
    gets a copy of the first row behind it, so a window per range sees every neighbour and texts move once."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = base.count()
    k = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    edges = base.agg(F.percentile_approx("id", [i / k for i in range(1, k)], 20 * k).alias("q")).first().q if k > 1 else []
    bounds = F.array(*[F.lit(x).cast("long") for x in sorted(set(edges or []))]).cast("array<bigint>")
    dealt = base.withColumn("bucket", F.size(F.filter(bounds, lambda b: F.col("id") >= b)))
    # the first row (by descending id) of every range, copied to the next range above; that of the top range to the lowest
    tops = dealt.groupBy("bucket").agg(F.max(F.struct("id", "text")).alias("top"))
    above = Window.orderBy("bucket")  # at most MAX_BUCKETS + 1 rows
    order = tops.select("bucket", F.coalesce(F.lead("bucket").over(above), F.min("bucket").over(
        above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    copies = tops.join(F.broadcast(order), "bucket").select("top.id", "top.text", F.col("to").alias("bucket"), F.lit(1).alias("copy"))
    rows = dealt.withColumn("copy", F.lit(0)).unionByName(copies)
    return rows.repartition("bucket"), Window.partitionBy("bucket").orderBy("copy", F.desc_nulls_last("id"), F.desc("text"))


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last half (rounded down, in code points) replaced by as many first code points of ``next_text``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def edit_test(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with the likeness of the first to the second and to the next text's."""
    rows, order = ranged(docs, id_col, text_col)
    rows = fingerprints(rows, "text", "spots")
    rows = rows.select("id", "text", "copy", "spots", F.lead("text").over(order).alias("next_text"), F.lead("spots").over(order).alias("next_spots"))
    rows = rows.where("copy = 0").withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = fingerprints(rows, "edited", "edited_spots")
    return rows.select(F.col("id").alias(id_col), F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("spots")).alias("fingerprint"), as_text(F.col("edited_spots")).alias("edited_fingerprint"),
                       likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
                       likeness(F.col("spots"), F.col("next_spots")).alias("near_next"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): ``members`` has (id, class_id), texts with equal fingerprints being one class named by its smallest id; ``pairs``
    has (a, b, likeness) of class names whose sets reach the threshold.  Empty sets form a class and pair with nothing.

    Sets are partitioned by length so that partners lie in the same or the next partition; within a partition they meet on the first
    ``size - ceil(threshold * size) + 1`` spots (any reaching pair shares one), pairs whose lengths cannot reach the threshold are pruned before
    their sets are joined."""
    from math import log

    sets = fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "text", "spots")
    sets = sets.select("id", "spots", F.sha2(as_text(F.col("spots")), 256).alias("key"))
    classes = sets.groupBy("key").agg(F.min("id").alias("class_id"), F.first("spots").alias("spots")).where(F.col("class_id").isNotNull())
    size = F.size("spots")
    sized = classes.where(size > 0).select("class_id", "spots", size.alias("n"), F.floor(F.log(size) / F.lit(-log(threshold)) + 1e-9).alias("part"))
    prefix = F.slice("spots", 1, F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)
    spots = sized.select("class_id", "n", "part", F.explode(prefix).alias("spot"))
    left = spots.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "spot", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = spots.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "spot", "part")
    fits = (F.col("na") <= F.col("nb")) & (F.col("na") >= F.col("nb") * threshold - 1e-9) & ((F.col("na") < F.col("nb")) | (F.col("a") < F.col("b")))
    met = left.join(right, ["spot", "part"]).where(fits).select("a", "b").distinct()
    pairs = (met.join(sized.select(F.col("class_id").alias("a"), F.col("spots").alias("sa")), "a")
             .join(sized.select(F.col("class_id").alias("b"), F.col("spots").alias("sb")), "b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likeness(F.col("sa"), F.col("sb"), 9).alias("likeness"))
             .where(F.col("likeness") >= threshold))
    return sets.join(classes.select("key", "class_id"), "key", "left").select(F.col("id").alias(id_col), "class_id"), pairs
