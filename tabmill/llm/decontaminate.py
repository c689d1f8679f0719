"""Benchmark decontamination: rare word pairs as seeds, then Smith-Waterman alignment.

``score`` is the best local alignment score of item and document over that of an exact copy, so edited and reordered copies score by what they keep.

The seeds follow from the threshold t.  With M matched words and E edits, 2 M - E >= 2 t m for an item of m words.  An edit cost of
2 or more lies between at most E / 2 of the M - 1 neighbouring matches, so at least t m - 1 of them are at most two words apart in item and
document alike.  Seeds are the ordered word pairs at distance one and two; a pair counts at its left word's place.  Of the m - 1 left places
the commonest ``1 - RARE`` are left out, by word frequencies over all documents, and as many hits fewer are required.  (A widely copied item keeps its seeds, since copies
hardly change the frequency of single words.)  An alignment spans at most (3 - 2 t) m words, so the hits are counted within
that reach; no document that the score accepts is missed.

Fixed-size bitmaps of words, seeds and candidate texts go to the scanning tasks; the items themselves are joined by Spark.

Defined cases: words are runs of letters and digits, lower-cased; null and empty documents or items match nothing; items of one word are found
in texts of that word, items of two words only where both are; equal items are all reported; repeated rows are reported once per
(doc_id, item_id) with the best score; null ids are carried as ids; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import bitmap, marked, written

RARE = 0.7
THRESHOLD = 0.45
MATCH, MISMATCH, GAP = 2, -1, -1
BITS = 1 << 24


def _slices(batch: pa.RecordBatch, name: str):
    for first, data, at in tv.slices(pc.utf8_lower(batch.column(batch.schema.get_field_index(name)))):
        yield first, tv.Words(data, at, lower=False, kind=tv.PLAIN)


def item_words(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words): the word hashes of every item that has words."""

    def run(batches):
        for batch in batches:
            for first, words in _slices(batch, "text"):
                parts = [pa.array(tv.signed(p)) for p in tv.per_text(words.hash, words.doc, words.n)]
                ids = batch.column(0).slice(first, words.n)
                out = pa.record_batch([ids, pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))], names=["item_id", "words"])
                yield out.filter(pa.array(words.count > 0))

    return benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "item_id long, words array<long>")


def word_counts(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(word, n) over all documents, of the words marked in ``bits``; every task sends one sum per word."""

    def run(batches):
        seen, counts = [], []
        for batch in batches:
            for _, words in _slices(batch, "text"):
                v, c = np.unique(words.hash[marked(bits, words.hash)], return_counts=True)
                seen.append(v)
                counts.append(c)
            if len(seen) > 256:
                v, at = np.unique(np.concatenate(seen), return_inverse=True)
                seen, counts = [v], [np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)]
        if seen:
            v, at = np.unique(np.concatenate(seen), return_inverse=True)
            yield pa.record_batch([pa.array(tv.signed(v)), pa.array(np.bincount(at, weights=np.concatenate(counts)).astype(np.int64))],
                                  names=["word", "n"])

    return docs.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return tv.mix(left * np.uint64(tv._SALTS[0]) + right * np.uint64(tv._SALTS[1]) + np.uint64(2))


def seeds(items: DataFrame, counts: DataFrame, threshold: float = THRESHOLD, rare: float = RARE) -> DataFrame:
    """(item, need, left, seed): the word pairs of each item at its rarest left places, and how many of these places a copy must meet;
    ``items`` has one row an item."""
    place = items.select("item", F.size("words").alias("m"), F.posexplode("words").alias("left", "w0"))
    rarity = place.join(counts.withColumnRenamed("word", "w0"), "w0", "left").withColumn("lf", F.log(F.coalesce("n", F.lit(0)) + 1.0))
    order = Window.partitionBy("item").orderBy("left")
    pairs = rarity.select("item", "m", "left", "w0", F.lead("w0", 1).over(order).alias("w1"), F.lead("w0", 2).over(order).alias("w2"),
                          (F.col("lf") + F.greatest(F.lead("lf", 1, 0.0).over(order), F.lead("lf", 2, 0.0).over(order))).alias("common"))
    met = F.greatest(F.lit(1), F.ceil(threshold * F.col("m") - 1 - 1e-9))  # left places that a copy meets at least
    spare = F.least(F.floor((1 - rare) * (F.col("m") - 1) + 1e-9), met - 1)
    rank = F.row_number().over(Window.partitionBy("item").orderBy("common", "left"))
    kept = (pairs.where((F.col("w1").isNotNull()) | (F.col("m") == 1)).withColumn("rank", rank)
            .where(F.col("rank") <= F.greatest(F.lit(1), F.col("m") - 1 - spare)).select("item", (met - spare).cast("long").alias("need"), "left", "w0", "w1", "w2"))

    def run(batches):
        for batch in batches:
            w0, w1, w2 = (batch.column(f"w{j}").fill_null(0).to_numpy().view(np.uint64) for j in range(3))
            one = batch.column("w1").is_null().to_numpy(zero_copy_only=False)
            near = np.where(one, tv.mix(w0 * np.uint64(tv._SALTS[0]) + np.uint64(1)), _pair_hash(w0, w1))  # one word: as textvec's short shingles
            far = batch.column("w2").is_valid().to_numpy(zero_copy_only=False)
            part = pa.concat_tables([pa.table(batch.select(["item", "need", "left"]).columns, names=["item", "need", "left"])] * 2).combine_chunks()
            both = part.append_column("seed", pa.array(tv.signed(np.concatenate((near, _pair_hash(w0, w2))))))
            yield from both.filter(pa.array(np.concatenate((np.ones(len(far), bool), far)))).to_batches()

    return kept.mapInArrow(run, "item long, need long, left int, seed long").distinct()


def seed_hits(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """(uid, pos, seed): where texts have seeds."""

    def run(batches):
        for batch in batches:
            uid = batch.column(0).to_numpy()
            for first, words in _slices(batch, "text"):
                near, doc = words.shingles(2)
                per = np.bincount(doc, minlength=words.n)
                pos = np.arange(len(near)) - np.repeat(np.cumsum(per) - per, per)
                ok = np.flatnonzero(words.doc[:-2] == words.doc[2:]) if len(words.doc) > 2 else np.zeros(0, np.int64)
                far = _pair_hash(words.hash[ok], words.hash[ok + 2])
                h = np.concatenate((near, far))
                d, p = np.concatenate((doc, words.doc[ok])), np.concatenate((pos, ok - words.first[words.doc[ok]]))
                hit = np.flatnonzero(marked(bits, h))
                yield pa.record_batch([pa.array(uid[first + d[hit]]), pa.array(p[hit]), pa.array(tv.signed(h[hit]))], names=["uid", "pos", "seed"])

    return texts.select("uid", "text").mapInArrow(run, "uid long, pos long, seed long")


def words_of(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """(uid, doc_id, words) of the texts marked in ``bits``."""

    def run(batches):
        for batch in batches:
            some = batch.filter(pa.array(marked(bits, batch.column("uid").to_numpy().view(np.uint64))))
            for first, words in _slices(some, "text"):
                part = some.slice(first, words.n)
                lists = pa.ListArray.from_arrays(pa.array(words.first.astype(np.int32)), pa.array(tv.signed(words.hash)))
                yield pa.record_batch([part.column("uid"), part.column("doc_id"), lists], names=["uid", "doc_id", "words"])

    return texts.select("uid", "doc_id", "text").mapInArrow(run, "uid long, doc_id long, words array<long>")


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best local alignment score, end position in ``text``), row by row; gaps along a row by a running maximum."""
    at = np.arange(len(text)) * -GAP
    row, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for w in item:
        match = np.where(text == w, MATCH, MISMATCH)
        new = np.maximum(np.maximum(row[:-1] + match, row[1:] + GAP), 0)
        new = np.maximum.accumulate(new + at) - at
        row[1:] = new
        j = int(np.argmax(new))
        if new[j] > best:
            best, end = int(new[j]), j + 1
    return best, end


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of every document passage that aligns with an item at ``threshold`` or more."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where("text is not null").withColumn("uid", F.xxhash64("text"))
    # an item is a word list, whatever ids its rows have: repeated and null ids are met again in ``names`` only
    named = written(item_words(benchmark, item_col, item_text_col).withColumn("item", F.xxhash64("words")), "items")
    names = named.select("item", "item_id").distinct()
    items = written(named.select("item", "words").dropDuplicates(["item"]), "distinct-items")
    words = items.select(F.explode("words").alias("word"))
    counts = word_counts(texts.select("text"), bitmap(words, "word", BITS))
    rare = written(seeds(items, counts, threshold), "seeds")
    reach = int((3 - 2 * threshold) * (items.agg(F.max(F.size("words"))).first()[0] or 0)) + 1
    hits = seed_hits(texts, bitmap(rare, "seed", BITS)).distinct().join(rare, "seed").select("uid", "item", "need", "pos", "left")
    near = Window.partitionBy("uid", "item").orderBy("pos").rangeBetween(0, reach)
    pairs = written(hits.withColumn("met", F.size(F.collect_set("left").over(near))).where(F.col("met") >= F.col("need")).groupBy("uid", "item")
                    .agg(F.min("pos").alias("low"), F.max("pos").alias("high")), "pairs")
    found = written(words_of(texts, bitmap(pairs, "uid", BITS)), "candidates")
    start = F.greatest(F.lit(0), F.col("low") - reach)
    both = (pairs.join(items, "item").join(found.dropDuplicates(["uid"]).select("uid", F.col("words").alias("all")), "uid")
            .select("uid", "item", start.alias("start"), "words",
                    F.slice("all", (start + 1).cast("int"), (F.col("high") + 2 * reach + 2 - start).cast("int")).alias("text_words")))

    def run(batches):
        fields = ["uid", "item", "score", "first_word", "last_word"]
        for batch in batches:
            rows = []
            doc, of, start, item, text = (batch.column(c) for c in ("uid", "item", "start", "words", "text_words"))
            for i in range(batch.num_rows):
                a, b = item[i].values.to_numpy(), text[i].values.to_numpy()
                best, end = align(a, b)
                if best >= threshold * MATCH * len(a):
                    _, back = align(a[::-1], b[:end][::-1])
                    rows.append((doc[i].as_py(), of[i].as_py(), round(best / (MATCH * len(a)), 6), start[i].as_py() + end - back,
                                 start[i].as_py() + end - 1))
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=fields)

    matches = both.mapInArrow(run, "uid long, item long, score double, first_word long, last_word long")
    best = F.struct("score", -F.col("first_word"), "last_word")
    ids = found.select("uid", "doc_id").distinct()
    return (matches.join(names, "item").join(ids, "uid").groupBy("doc_id", "item_id").agg(F.max(best).alias("b"))
            .select("doc_id", "item_id", "b.score", (-F.col("b.col2")).alias("first_word"), "b.last_word"))
