"""Ranked lexical search over a length-stratified index.

The score of a document for an item sums ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` over the item's terms, where ``w``
depends on the term alone and ``m`` on the document's length alone.  So documents of equal ``m`` form a stratum, in which a posting's
impact depends on its tf only.  The index has a row per stratum of a segment (the documents a task has read, up to a size): the ids and, per
term, the documents by tf; an impact is computed once per tf.  The largest tf of each term bounds what any document of the stratum can
score for an item.  A search task visits strata in the order of these bounds, keeps the k best documents of every item, and
leaves an item out of a stratum whose bound is below its k-th score.

Segments are built where the documents are read: nothing is shuffled but the term statistics and every task's k best.  Items are handled in blocks of a
bounded number of terms; the index of a block holds the postings of its terms, or of all terms if none are given.

Terms are the maximal runs of ASCII letters, ASCII digits and non-ASCII characters, A-Z lower-cased; 64-bit hashes stand for them.

Defined cases: null and empty texts and texts without terms score nothing; an item without terms finds nothing; every item row is a query of
its own, also if ids repeat; documents with equal ids are ranked one by one; ids are longs, nulls rank behind all others among equal
scores; long texts are read in parts; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import written

K = 10
SEGMENT_DOCS = 1 << 14
SEGMENT_POSTINGS = 1 << 21
BLOCK_DOCS = 1 << 12  # documents of a stratum in one row
BLOCK_TERMS = 1 << 18  # (item, term) pairs of a block of items
PART = 1 << 20  # bytes of a text that are read at once
CELLS = 1 << 20  # scores computed at once
NO_ID = np.iinfo(np.int64).max  # stands for a null id
EXACT = float(1 << 52)  # sums of whole numbers below are exact in doubles

TERM = np.zeros(256, np.uint8)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def _parts(data: np.ndarray):
    """Parts of one text, cut behind bytes that belong to no term."""
    a = 0
    while a < len(data):
        b, back = min(a + PART, len(data)), np.zeros(0, np.int64)
        while b < len(data):
            back = np.flatnonzero(TERM[data[a:b]] == 0)
            if len(back):
                break
            b = min(b + PART, len(data))
        b = a + int(back[-1]) + 1 if len(back) and b < len(data) else b
        yield data[a:b]
        a = b


def _pieces(column):
    """(first row, bytes, offsets) of slices; a text longer than a part comes in several pieces of the same row."""
    for first, data, at in tv.slices(column):
        if len(at) == 2 and len(data) > PART:
            for part in _parts(data):
                yield first, part, np.array([0, len(part)])
        else:
            yield first, data, at


def term_counts(column) -> np.ndarray:
    """Number of terms of each text."""
    out = np.zeros(len(column), np.int64)
    for first, data, at in _pieces(column):
        of = TERM[data] > 0
        border = np.zeros(len(data) + 1, bool)
        border[at] = True
        begin = of.copy()
        begin[1:] &= ~of[:-1] | border[1:len(data)]
        np.add.at(out, first + np.searchsorted(at, np.flatnonzero(begin), "right") - 1, 1)
    return out


def postings(column, terms: np.ndarray | None):
    """Yield (row, term hash, occurrences) arrays of a string column's slices; only of ``terms`` (sorted) if given.
    Texts in several pieces give a term more than once."""
    for first, data, at in _pieces(column):
        words = tv.Words(data, at, kind=TERM)
        if terms is None:
            known, which = np.unique(words.hash, return_inverse=True)
            doc = words.doc
        else:
            known = terms
            which = np.minimum(np.searchsorted(known, words.hash), max(0, len(known) - 1))
            kept = np.flatnonzero(known[which] == words.hash) if len(known) else np.zeros(0, np.int64)
            which, doc = which[kept], words.doc[kept]
        pair, tf = np.unique(doc * max(1, len(known)) + which, return_counts=True)
        yield first + pair // max(1, len(known)), known[pair % max(1, len(known))], tf


def corpus_totals(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents with at least one term, terms of all documents)."""

    def run(batches):
        n = total = 0
        for batch in batches:
            counts = term_counts(batch.column(0))
            n, total = n + int((counts > 0).sum()), total + int(counts.sum())
        yield pa.record_batch([pa.array([n]), pa.array([total])], names=["n", "total"])

    row = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "n long, total long")
           .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first())
    return int(row.n or 0), int(row.total or 0)


_INDEX = T.StructType([T.StructField("m", T.LongType()), *(T.StructField(c, T.BinaryType()) for c in (
    "ids", "terms", "tfs", "sizes", "members"))])


def stratum_rows(ids: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray):
    """Index rows of a segment: per stratum (and block of it) the ids and, by (term, tf), the documents that hold it."""
    order = np.argsort(m, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    m, ids = m[order], ids[order]
    starts = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
    cuts = np.unique(np.concatenate([starts, *(np.arange(a, b, BLOCK_DOCS) for a, b in zip(starts, [*starts[1:], len(m)]))]))
    ends = np.concatenate((cuts[1:], [len(m)]))
    doc = place[doc]
    block = np.searchsorted(cuts, doc, "right") - 1
    order = np.lexsort((doc, tf, term, block))
    doc, term, tf, block = doc[order], term[order], tf[order], block[order]
    new = np.concatenate(([True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1]) | (block[1:] != block[:-1]))) if len(doc) else np.zeros(0, bool)
    group = np.flatnonzero(new)
    sizes = np.diff(np.concatenate((group, [len(doc)]))).astype(np.int32)
    in_block = np.searchsorted(block[group], np.arange(len(cuts) + 1))
    post = np.searchsorted(block, np.arange(len(cuts) + 1))
    for b, (a, z) in enumerate(zip(cuts.tolist(), ends.tolist())):
        g, p = slice(in_block[b], in_block[b + 1]), slice(post[b], post[b + 1])
        if g.start < g.stop:
            yield (int(m[a]), ids[a:z].tobytes(), term[group[g]].tobytes(), tf[group[g]].astype(np.int32).tobytes(),
                   sizes[g].tobytes(), (doc[p] - a).astype(np.int32).tobytes())


def build_index(docs: DataFrame, totals: tuple[int, int], terms: np.ndarray | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The written index of ``docs``, of all terms or of the given hashes (sorted): a row per stratum of a segment."""
    n_docs, n_terms = totals
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        held: list[tuple] = []
        ids, lengths, docs_held, posts_held = [], [], 0, 0

        def flush():
            nonlocal held, ids, lengths, docs_held, posts_held
            counts = np.concatenate(lengths)
            of = {int(n): 25 + 75 * int(n) * n_docs // n_terms for n in np.unique(counts[counts > 0])}
            kept = np.flatnonzero(counts > 0)
            m = np.array([of[n] for n in counts[kept].tolist()], np.int64)
            place = np.zeros(len(counts), np.int64)
            place[kept] = np.arange(len(kept))
            doc, term, tf = (np.concatenate(x) for x in zip(*held))
            rows = list(stratum_rows(np.concatenate(ids)[kept], m, place[doc], term, tf)) if len(doc) else []
            held, ids, lengths, docs_held, posts_held = [], [], [], 0, 0
            for k in range(0, len(rows), 256):
                cols = list(zip(*rows[k:k + 256]))
                yield pa.record_batch([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=_INDEX.names)

        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids.append(pc.fill_null(part.column(0), NO_ID).to_numpy(zero_copy_only=False).astype(np.int64))
                lengths.append(term_counts(part.column(1)))
                found = [np.concatenate(x) for x in zip(*postings(part.column(1), terms))]
                if found:
                    row, term, tf = found
                    if len(row) and pc.max(pc.binary_length(part.column(1))).as_py() > PART:
                        key = np.lexsort((term, row))  # a long text gives a term once for every piece
                        row, term, tf = row[key], term[key], tf[key]
                        new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (term[1:] != term[:-1]))))
                        row, term, tf = row[new], term[new], np.add.reduceat(tf, new)
                    held.append((docs_held + row, term, tf))
                    posts_held += len(row)
                docs_held += part.num_rows
                if docs_held >= SEGMENT_DOCS or posts_held >= SEGMENT_POSTINGS:
                    if held:
                        yield from flush()
        if held:
            yield from flush()

    return written(base.mapInArrow(run, _INDEX), "search-index")


def document_frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents that hold each of ``terms`` (sorted hashes), summed over the index rows."""

    def run(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for t, s in zip(batch.column(0), batch.column(1)):
                t, s = np.frombuffer(t.as_py(), np.uint64), np.frombuffer(s.as_py(), np.int32)
                at = np.minimum(np.searchsorted(terms, t), len(terms) - 1)
                same = terms[at] == t
                total += np.bincount(at[same], weights=s[same], minlength=len(terms)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["at", "df"])

    out = np.zeros(len(terms), np.int64)
    if len(terms):
        for r in index.select("terms", "sizes").mapInArrow(run, "at long, df long").groupBy("at").agg(F.sum("df").alias("df")).collect():
            out[r["at"]] = r.df
    return out


class Searcher:
    """Scores index rows for a block of items; made once per task.  ``entries``: (item, term position, count) arrays ordered by item."""

    def __init__(self, terms: np.ndarray, weight: np.ndarray, entries: tuple[np.ndarray, np.ndarray, np.ndarray], items: int, k: int):
        self.terms, self.weight, self.k, self.items = terms, weight, k, items
        self.item, self.term, self.count = entries
        self.first = np.searchsorted(self.item, np.arange(items))
        self.any = np.bincount(self.item, minlength=items) > 0
        full = np.bincount(self.item, weights=self.count * weight[self.term] * 1e6, minlength=items)
        self.full = np.maximum(full, 1.0)
        self.exact = full.max(initial=0) < EXACT
        self.least = np.zeros(items, np.int64)  # k-th score of each item so far
        self.best = [np.zeros(0, np.int64)] * 3  # item, score, id
        self.fresh, self.waiting = [], 0

    def open(self, m: int, terms, tfs, sizes, members):
        """Of an index row: known term positions, their contributions by group, and group sizes."""
        terms, tfs = np.frombuffer(terms, np.uint64), np.frombuffer(tfs, np.int32)
        sizes, members = np.frombuffer(sizes, np.int32), np.frombuffer(members, np.int32)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        if not known.all():
            members = members[np.repeat(known, sizes)]
            at, tfs, sizes = at[known], tfs[known], sizes[known]
        distinct, which = np.unique(tfs, return_inverse=True)
        distinct = distinct.astype(np.int64)
        impact = (1_000_000_000 * distinct) // (1000 * distinct + 8 * m)
        return at, self.weight[at] * impact[which], sizes, members

    def bounds(self, at: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """What a document of the row can score at most for each item: groups of a term end with its largest tf."""
        most = np.zeros(len(self.terms), np.int64)
        if len(at):
            last = np.flatnonzero(np.concatenate((at[1:] != at[:-1], [True])))
            most[at[last]] = gain[last]
        out = np.zeros(self.items, np.int64)
        if len(self.item):
            out[self.any] = np.add.reduceat(self.count * most[self.term], self.first[self.any])
        return out

    def visit(self, ids: np.ndarray, at: np.ndarray, gain: np.ndarray, sizes: np.ndarray, members: np.ndarray):
        bound = self.bounds(at, gain)
        active = (bound > 0) & (bound >= self.least)
        if not active.any():
            return
        n = len(ids)
        new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        behind = np.concatenate(([0], np.cumsum(sizes)))
        row_of = np.full(len(self.terms), -1, np.int64)
        row_of[at[new]] = np.arange(len(new))
        start, end = behind[new], behind[np.concatenate((new[1:], [len(at)]))]
        by_post = np.repeat(gain, sizes)
        pair = np.flatnonzero(active[self.item] & (row_of[self.term] >= 0))
        size = (end - start)[row_of[self.term[pair]]]
        load = np.cumsum(size)
        a = 0
        while a < len(pair):
            # whole items until CELLS scores or postings
            b = max(a + 1, int(np.searchsorted(load, (load[a - 1] if a else 0) + 4 * CELLS, "right")))
            b = int(np.searchsorted(self.item[pair], self.item[pair[min(b, len(pair)) - 1]], "right"))
            some, items = pair[a:b], np.unique(self.item[pair[a:b]])
            if len(items) * n > CELLS and len(items) > 1:
                items = items[:max(1, CELLS // n)]
                b = a + int(np.searchsorted(self.item[some], items[-1], "right"))
                some = pair[a:b]
            term, many = row_of[self.term[some]], size[a:b]
            total = np.cumsum(many)
            post = np.repeat(start[term] - (total - many), many) + np.arange(total[-1])
            cell = np.repeat(np.searchsorted(items, self.item[some]) * n, many) + members[post]
            gains = np.repeat(self.count[some], many) * by_post[post]
            if self.exact:
                score = np.bincount(cell, weights=gains, minlength=len(items) * n).astype(np.int64)
            else:
                score = np.zeros(len(items) * n, np.int64)
                np.add.at(score, cell, gains)
            hit = np.flatnonzero((score > 0) & (score >= np.repeat(self.least[items], n)))
            if len(hit):
                self.fresh.append((items[hit // n], score[hit], ids[hit % n]))
                self.waiting += len(hit)
            a = b
        if self.waiting > max(4096, self.items * self.k):
            self.settle()

    def settle(self):
        """Keep the k best of every item: by score, then by smaller id."""
        item, score, ids = (np.concatenate(x) for x in zip(self.best, *self.fresh))
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.k
        full = rank == self.k - 1
        self.least[item[full]] = score[full]
        self.best, self.fresh, self.waiting = [item[kept], score[kept], ids[kept]], [], 0


def search(index: DataFrame, terms: np.ndarray, weight: np.ndarray, entries, item_ids: pa.Array, k: int = K) -> DataFrame:
    """(query, item_id, doc_id, score): every task's ``k`` best documents of each item, which include the ``k`` best of all."""
    id_type = T.LongType() if pa.types.is_integer(item_ids.type) else T.StringType()
    if isinstance(id_type, T.StringType):
        item_ids = item_ids.cast(pa.string())
    else:
        item_ids = item_ids.cast(pa.int64())
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("item_id", id_type),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    items = len(item_ids)

    def run(batches):
        searcher = Searcher(terms, weight, entries, items, k)
        for batch in batches:
            m, rows = batch.column(0).to_pylist(), list(zip(*(batch.column(c) for c in range(1, 6))))
            view = [[v.as_buffer() for v in r] for r in rows]
            value = np.zeros(len(rows))
            for i, r in enumerate(view):
                value[i] = (searcher.bounds(*searcher.open(m[i], *r[1:])[:2]) / searcher.full).max(initial=0)
            for i in np.argsort(-value, kind="stable").tolist():
                searcher.visit(np.frombuffer(view[i][0], np.int64), *searcher.open(m[i], *view[i][1:]))
        if searcher.fresh:
            searcher.settle()
        item, score, ids = searcher.best
        yield pa.record_batch([pa.array(item), item_ids.take(pa.array(item)),
                               pa.array(ids, mask=ids == NO_ID), pa.array(score)], names=schema.names)

    return index.mapInArrow(run, schema)


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query, item_id, term, count): the terms of every item row, which gets a number of its own."""
    base = items.select(F.monotonically_increasing_id().alias("query"), F.col(id_col).alias("item_id"),
                        F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([*base.schema.fields[:2], T.StructField("term", T.LongType()), T.StructField("count", T.LongType())])

    def run(batches):
        for batch in batches:
            found = [np.concatenate(x) for x in zip(*postings(batch.column(2), None))]
            if found:
                row = pa.array(found[0])
                yield pa.record_batch([batch.column(0).take(row), batch.column(1).take(row), pa.array(tv.signed(found[1])),
                                       pa.array(found[2])], names=schema.names)

    return written(base.mapInArrow(run, schema), "query-terms")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of every item, equal scores by smaller id."""
    asked = query_terms(items, item_col, item_text_col)
    totals = corpus_totals(docs, text_col)
    blocks = 1 + asked.count() // BLOCK_TERMS
    found = None
    for b in range(blocks if totals[0] else 0):
        part = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).orderBy("query", "term").toArrow()
        if not len(part):
            continue
        hashes = part.column("term").to_numpy().view(np.uint64)
        terms, term = np.unique(hashes, return_inverse=True)
        _, first, item = np.unique(part.column("query").to_numpy(), return_index=True, return_inverse=True)
        # a term of an item in several pieces has several entries: they add up
        index = build_index(docs, totals, terms, id_col, text_col)
        weight = weights(document_frequencies(index, terms), totals[0])
        best = search(index, terms, weight, (item, term, part.column("count").to_numpy()),
                      part.column("item_id").combine_chunks().take(pa.array(first)), k)
        best = best.withColumn("query", F.col("query") * blocks + b)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return items.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", items.schema[item_col].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("item_id").cast(items.schema[item_col].dataType).alias("item_id"), "rank", "doc_id", "score"))
