"""N-gram Jaccard join: blocked sparse product of the document by n-gram incidence.

The incidence matrix has one row per distinct n-gram set (equal sets are one class) and one column
per n-gram.  Two classes can only reach the threshold if they meet in the size-derived prefix of
both rows under one global column order (most frequent columns last), so the product is
accumulated over those columns first and everything below the bounds is discarded:

* columns met by at most ``BUCKET`` classes give pairs within the size bound, whose overlap counts are accumulated
  over columns; pairs that can no longer reach the threshold go;
* remaining pairs, and columns met by more classes, join classes into families, cut into tiles of ``TILE``
  classes; each pair of tiles is one block of the product over all columns: overlap counts accumulate over column
  groups, the exact test is applied, and a spanning set of links leaves it.

The order of the columns never changes the result, only the work.  It ranks up to ``HEAVY`` of the most
frequent n-grams, counted over all texts, behind the others; that list has a fixed size bound and is
shipped with the tasks.  Columns counted ``HOT`` times or more are salted, so no task gathers a hot one.

Defined cases: null and empty texts have an empty set and link with nothing; texts of fewer than ``n``
words are one shingle; equal texts, repeated rows and repeated ids share a class; a null id stays null
and never names a component others share unless all its members have null ids; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import ROWS_PER_FILE, bitmap, connected_components, marked, written

BUCKET = 48
TILE = 512
TILE_SHINGLES = 400_000  # shingles of a tile, about
HOT = 512  # count from which a column of the heavy list is salted
HEAVY = 1 << 18
SALTS = 8
SHARE = 20  # one more prefix column for so many shingles
BITMAP_BITS = 1 << 25


def _sets(batch: pa.RecordBatch, n: int):
    """(row, sorted distinct shingle hashes) of every text with a non-empty set."""
    for first, data, at in tv.slices(batch.column(batch.schema.get_field_index("text"))):
        words = tv.Words(data, at)
        h, doc = words.shingles(n)
        for i, part in enumerate(tv.per_text(h, doc, words.n)):
            yield first + i, np.unique(part)


def _signature(s: np.ndarray) -> int:
    """Order-free 64-bit signature of a set (0 for the empty one)."""
    with np.errstate(over="ignore"):
        return int(tv.mix(np.array([tv.mix(s + np.uint64(len(s))).sum(dtype=np.uint64)])).view(np.int64)[0]) if len(s) else 0


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _scan(texts: DataFrame, n: int) -> DataFrame:
    """One pass: kind 0 = (doc_id, set size, signature); kind 1 = (n-gram, count, -) of n-grams that are
    frequent within a slice of a task."""

    def run(batches):
        many, counts = [], []
        for batch in batches:
            size, sig = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            pending, held = [], 0
            for row, s in _sets(batch, n):
                size[row], sig[row] = len(s), _signature(s)
                pending.append(s)
                held += len(s)
                if held > 2_000_000:
                    v, c = np.unique(np.concatenate(pending), return_counts=True)
                    many.append(v[c >= 3])
                    counts.append(c[c >= 3])
                    pending, held = [], 0
            if pending:
                v, c = np.unique(np.concatenate(pending), return_counts=True)
                many.append(v[c >= 3])
                counts.append(c[c >= 3])
            yield pa.record_batch([pa.array(np.zeros(len(size), np.int32)), batch.column(0), pa.array(size), pa.array(sig)],
                                  names=["kind", "a", "b", "c"])
        if many:
            v, at = np.unique(np.concatenate(many), return_inverse=True)
            c = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)
            yield pa.record_batch([pa.array(np.ones(len(v), np.int32)), pa.array(tv.signed(v)), pa.array(c),
                                   pa.array(np.zeros(len(v), np.int64))], names=["kind", "a", "b", "c"])

    return texts.mapInArrow(run, "kind int, a long, b long, c long")


def _heavy(scan: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``HEAVY`` most frequent n-grams (sorted) and their counts: the only collected table, of fixed size."""
    top = (scan.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n"))
           .orderBy(F.desc("n"), "a").limit(HEAVY).collect())
    v = np.array([r.a for r in top], dtype=np.int64).view(np.uint64)
    c = np.array([r.n for r in top], dtype=np.int64)
    order = np.argsort(v)
    return v[order], c[order]


def _rank(s: np.ndarray, heavy: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Count of each n-gram in the heavy list, 0 for the others."""
    if not len(heavy):
        return np.zeros(len(s), np.int64)
    at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
    return np.where(heavy[at] == s, counts[at], 0)


def shared(size):
    """Columns that two linked rows share in their prefixes at least (the smaller of both rows' values).

    A prefix has ``size - ceil(t * size) + shared(size)`` columns.  Of two linked rows, let x be the one whose prefix ends
    first: at most ``ceil(t * size_x) - shared(size_x)`` of the common columns, ``t * size_x`` or more, lie behind it."""
    return 1 + size // SHARE


def _prefixes(texts: DataFrame, n: int, num: int, den: int, heavy: np.ndarray, counts: np.ndarray) -> DataFrame:
    """Prefix incidences (token, salt, size, sig, heavy), once per class and task; ``heavy`` counts the
    class's prefix columns that are salted."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            parts = []
            for _, s in _sets(batch, n):
                if not len(s):
                    continue
                sig = _signature(s)
                if sig in seen:
                    continue
                if len(seen) < 200_000:  # spares repeated rows; distinct() below removes the rest
                    seen.add(sig)
                k = len(s) - -(-num * len(s) // den) + shared(len(s))
                r = _rank(s, heavy, counts)
                if r.any():
                    order = np.lexsort((s, r))[:k]
                    token, r = s[order], r[order]
                else:
                    token, r = s[:k], r[:k]
                salt = np.where(r >= HOT, 1 + sig % SALTS, 0).astype(np.int32)
                parts.append((tv.signed(token), salt, np.full(k, len(s), np.int32), np.full(k, sig, np.int64),
                              np.full(k, np.count_nonzero(r >= HOT), np.int32)))
            if parts:
                cols = [np.concatenate(x) for x in zip(*parts)]
                yield pa.record_batch([pa.array(x) for x in cols], names=["token", "salt", "size", "sig", "heavy"])

    return texts.mapInArrow(run, "token long, salt int, size int, sig long, heavy int")


def _buckets(prefixes: DataFrame, num: int, den: int) -> DataFrame:
    """Per (token, salt), met in order of size: kind 0 = candidate pair (a, b); kind 1 = member
    (token, salt, sig, size) of a column that is salted or met by more than ``BUCKET`` classes."""

    def fits(small, large):
        return small * den >= num * large

    def pairs(token, size, sig, heavy):
        """All pairs of neighbours within a group whose sizes can reach the threshold."""
        at, left, right = np.arange(len(token)), [], []
        for d in range(1, BUCKET):
            at = at[at + d < len(token)]
            at = at[token[at] == token[at + d]]
            if not len(at):
                break
            ok = at[fits(size[at], size[at + d]) & (sig[at] != sig[at + d])]
            left.append(np.where(sig[ok] < sig[ok + d], ok, ok + d))
            right.append(np.where(sig[ok] < sig[ok + d], ok + d, ok))
        if left:
            x, y = np.concatenate(left), np.concatenate(right)
            yield out(0, len(x), a=sig[x], b=sig[y], size=size[x], size_b=size[y], heavy=heavy[x], heavy_b=heavy[y])

    def out(kind, n, **cols):
        names = ["kind", "a", "b", "token", "salt", "size", "size_b", "heavy", "heavy_b"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.int32()] * 5]
        return pa.record_batch([pa.array(np.full(n, kind, np.int32)) if c == "kind" else
                                (pa.array(cols[c], type=t) if c in cols else pa.nulls(n, t)) for c, t in zip(names, types)],
                               names=names)

    def run(batches):
        held = None  # the group that a batch border may cut: at most BUCKET rows
        big = None  # the key of the large group being streamed
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            held = None
            token, salt, size, sig, heavy = cols
            if not len(token):
                continue
            change = np.flatnonzero((token[1:] != token[:-1]) | (salt[1:] != salt[:-1])) + 1
            starts, stops = np.concatenate(([0], change)), np.concatenate((change, [len(token)]))
            n = stops - starts
            key0 = (int(token[0]), int(salt[0]))
            large = (n > BUCKET) | (salt[starts] > 0)
            if big is not None:
                large[0] |= big == key0
            if not large[-1]:  # may go on in the next batch
                held = [c[starts[-1]:] for c in cols]
                starts, stops, n, large = starts[:-1], stops[:-1], n[:-1], large[:-1]
            for s, e in zip(starts[large], stops[large]):
                yield out(1, e - s, a=sig[s:e], token=token[s:e], salt=salt[s:e], size=size[s:e])
                big = (int(token[s]), int(salt[s]))
            few = np.repeat(~large & (n > 1), n)
            few = np.concatenate((few, np.zeros(len(token) - len(few), bool)))
            if few.any():
                yield from pairs(token[few], size[few], sig[few], heavy[few])
        if held is not None and len(held[0]) > 1:
            yield from pairs(held[0], *held[2:])

    return prefixes.mapInArrow(run, "kind int, a long, b long, token long, salt int, size int, size_b int, "
                                    "heavy int, heavy_b int")


def _candidates(buckets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose overlap, accumulated over the prefix columns, can still reach the threshold.

    Of two prefixes, one ends first in the column order; what its row shares beyond the counted columns
    is at most the rest of that row.  Columns met through tiles are not counted in ``c``: they are added as if shared.
    """
    tiled = (buckets.where("kind = 1 and salt = 0").groupBy("a").agg(F.count("*").alias("extra"))
             .select(F.col("a").alias("sig"), "extra"))
    met = (buckets.where("kind = 0").groupBy("a", "b")
           .agg(F.count("*").alias("c"), *[F.first(x).alias(x) for x in ("size", "size_b", "heavy", "heavy_b")]))
    for end, heavy in (("a", "heavy"), ("b", "heavy_b")):
        met = (met.join(tiled.withColumnRenamed("sig", end), end, "left")
               .withColumn(heavy, F.col(heavy) + F.coalesce("extra", F.lit(0))).drop("extra"))

    def rest(n):  # shingles of a row behind its prefix
        return F.ceil(n * num / den) - 1 - F.floor(n / SHARE)

    bound = F.col("c") + F.least("heavy", "heavy_b") + F.greatest(rest(F.col("size")), rest(F.col("size_b")))
    return met.where(bound * (num + den) >= num * (F.col("size") + F.col("size_b"))).select("a", "b")


def _wanted(texts: DataFrame, n: int, sigs: np.ndarray, ids: np.ndarray) -> DataFrame:
    """(sig, set) of the documents whose signature and id the two bitmaps mark: the class representatives
    (a task sends a class once; false marks are dropped by the join that follows)."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            doc = batch.column(0)
            rep = marked(ids, doc.fill_null(0).to_numpy().view(np.uint64)) | doc.is_null().to_numpy(zero_copy_only=False)
            sig, sets, held = [], [], 0
            for row, s in _sets(batch, n):
                if not (rep[row] and len(s)):
                    continue
                x = _signature(s)
                if x not in seen and marked(sigs, np.array([x]).view(np.uint64))[0]:
                    if len(seen) < 200_000:
                        seen.add(x)
                    sig.append(x)
                    sets.append(s.tobytes())
                    held += len(sets[-1])
                if held > 1 << 22:
                    yield pa.record_batch([pa.array(sig, pa.int64()), pa.array(sets, pa.binary())], names=["sig", "set"])
                    sig, sets, held = [], [], 0
            if sig:
                yield pa.record_batch([pa.array(sig, pa.int64()), pa.array(sets, pa.binary())], names=["sig", "set"])

    return texts.mapInArrow(run, "sig long, set binary")


def block_links(sig: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """One block of the product: overlap counts over column groups, then a spanning set of the links."""
    k = len(sets)
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(k), size)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    overlap = np.zeros((k, k), np.float32)
    dense = np.flatnonzero(count >= 24)
    for part in np.array_split(dense, max(1, len(dense) // 2048)):
        if len(part):
            place = np.full(len(count), -1)
            place[part] = np.arange(len(part))
            at = place[column]
            block = np.zeros((k, len(part)), np.float32)
            block[row[at >= 0], at[at >= 0]] = 1
            overlap += block @ block.T
    thin = (count[column] >= 2) & (count[column] < 24)
    r, c = row[thin], column[thin]
    order = np.argsort(c, kind="stable")
    r, c = r[order], c[order]
    at = np.arange(len(r))
    flat = np.zeros(k * k, np.float32)
    for d in range(1, 24):
        at = at[at + d < len(r)]
        at = at[c[at] == c[at + d]]
        if not len(at):
            break
        flat += np.bincount(r[at] * k + r[at + d], minlength=k * k)
    flat = flat.reshape(k, k)
    overlap += flat + flat.T
    linked = den * overlap >= num * (size[:, None] + size[None, :] - overlap)
    linked &= sig[:, None] != sig[None, :]
    a, b, left = [], [], linked.any(axis=1)
    while left.any():
        seed = int(np.argmax(left))
        reached = np.zeros(k, bool)
        reached[seed] = True
        front = reached
        while front.any():
            front = linked[front].any(axis=0) & ~reached
            reached |= front
        left &= ~reached
        members = np.flatnonzero(reached)
        members = members[members != seed]
        a.append(np.full(len(members), sig[seed]))
        b.append(sig[members])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _family_edges(buckets: DataFrame, num: int, den: int) -> DataFrame:
    """(x, y) between classes that may link: candidate pairs, and one star per column too common for pairs.

    Linked rows share ``shared`` prefix columns or more.  A row with fewer common columns than that (a long text around a widely
    copied passage) shares a column of the other kind with every partner, so only the pairs need it; stars are left
    to rows that consist of common columns.  Every link has both ends in one connected family of these edges."""
    large = buckets.where("kind = 1").select("token", "a", "size")
    least = F.floor(F.ceil(F.col("size") * num / den) / SHARE) + 1  # the smallest partner's share
    dense = (large.groupBy("a").agg(F.count("*").alias("n"), F.first("size").alias("size")).where(F.col("n") >= least).select("a"))
    large = large.join(dense, "a").select("token", "a")
    stars = large.join(large.groupBy("token").agg(F.min("a").alias("hub")), "token")
    return (_candidates(buckets, num, den).select(F.col("a").alias("x"), F.col("b").alias("y"))
            .unionByName(stars.select(F.col("a").alias("x"), F.col("hub").alias("y")).distinct()))


def _block_edges(families: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) within families, block by block: one group of rows per pair of tiles that sizes allow."""
    whole = families.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / TILE, F.sum("size") / TILE_SHINGLES)).alias("tiles"))
    members = (families.join(whole, "family").withColumn("tile", F.pmod(F.xxhash64("sig"), F.col("tiles")))
               .select("family", "tiles", "tile", "sig", "size"))
    tiles = members.groupBy("family", "tiles", "tile").agg(F.min("size").alias("lo"), F.max("size").alias("hi"))
    other = tiles.select("family", F.col("tile").alias("u"), F.col("lo").alias("lo_u"), F.col("hi").alias("hi_u"))
    blocks = (tiles.withColumnRenamed("tile", "t").join(other, "family").where("t <= u")
              .where((F.col("hi") * den >= num * F.col("lo_u")) & (F.col("hi_u") * den >= num * F.col("lo"))))
    ends = blocks.select("family", F.explode(F.array_distinct(F.array("t", "u"))).alias("tile"),
                         (F.col("t") * F.col("tiles") + F.col("u")).alias("block"))

    def edges(sig, sets):
        a, b = block_links(np.array(sig, np.int64), sets, num, den)
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        key, sig, sets = None, [], []
        for batch in batches:
            family, block, s = (batch.column(i).to_numpy() for i in range(3))
            for i in range(batch.num_rows):
                if key != (family[i], block[i]):
                    if len(sig) > 1:
                        yield edges(sig, sets)
                    key, sig, sets = (family[i], block[i]), [], []
                if not sig or sig[-1] != s[i]:  # rows of a class follow each other
                    sig.append(s[i])
                    sets.append(np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64))
        if len(sig) > 1:
            yield edges(sig, sets)

    rows = members.join(ends, ["family", "tile"]).select("sig", "family", "block").join(sets, "sig").select("family", "block", "sig", "set")
    return (rows.repartition("family", "block").sortWithinPartitions("family", "block", "sig")
            .mapInArrow(run, "a long, b long"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                       num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: (doc_id, n_shingles, class_id, component_id).

    Documents link when ``den * |A n B| >= num * |A u B|`` over their distinct ``n``-word shingles;
    ``component_id`` is the smallest id reachable by links; ``class_id`` the smallest id with the same set.
    """
    texts = _texts(docs, id_col, text_col)
    scan = written(_scan(texts, n), "jaccard-scan")
    members = scan.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), F.col("c").alias("sig"))
    heavy, counts = _heavy(scan)
    prefixes = _prefixes(texts, n, num, den, heavy, counts)
    spread = prefixes.repartition("token", "salt").dropDuplicates(["token", "salt", "size", "sig", "heavy"])
    buckets = written(_buckets(spread.sortWithinPartitions("token", "salt", "size", "sig"), num, den), "jaccard-buckets")
    files = 1 + members.count() // ROWS_PER_FILE
    classes = written(members.where("n_shingles > 0").groupBy("sig").agg(
        F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("size")).coalesce(files), "jaccard-classes")
    family = connected_components(_family_edges(buckets, num, den), "x", "y")
    families = written(family.select(F.col("node").alias("sig"), F.col("component").alias("family")).join(classes, "sig").coalesce(files),
                       "jaccard-families")
    sets = _wanted(texts, n, bitmap(families, "sig", BITMAP_BITS), bitmap(families.where("class_id is not null"), "class_id", BITMAP_BITS))
    links = written(_block_edges(families.drop("class_id"), sets, num, den), "jaccard-links")
    reach = connected_components(links)

    named = classes.join(reach.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "root", F.coalesce("component", "sig"))
    first = named.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = named.join(first, "root").select("sig", "class_id", "component_id")
    return members.join(named, (members.sig == named.sig) & (members.n_shingles > 0), "left").select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"))
