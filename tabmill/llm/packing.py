"""Packing documents into token sequences by bounded-space online packing.

Every task tokenises its partition and keeps a fixed number of open windows.  A document that fills whole windows gives
them at once; the rest of it goes to the open window where it fits best (the least space left).  When it fits nowhere, the fullest
window is emitted: if its space is at least ``MIN_PIECE`` tokens, the head of the document fills it first, else it is padded.  The windows
still open at the end of a partition are merged across neighbouring partitions (``MERGED`` of them to a group, so a group holds
at most ``MERGED * open_windows`` windows): best fit by decreasing length, then gaps are filled from the emptiest
window, and the one window left over is cut into sequences whose lengths are powers of two, which need no padding.

Tokens come from a ``tokenizers`` vocabulary.  For vocabularies that split on white space and between letters and ASCII
punctuation, the distinct chunks of a slice are encoded once per task and texts are put together as arrays; others are encoded whole.

Defined cases: a null text counts as empty (its only token is the closing id); texts of any length are tokenised in parts and
may span many sequences; rows with equal or null ids are packed one by one; an empty table gives an empty result; other columns
of the input are not read.
"""

from __future__ import annotations

import bisect
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import written

SIZE = 4096
OPEN = 32  # windows a task keeps open
MIN_PIECE = 16  # tokens; smaller gaps are padded rather than filled by a cut
MERGED = 16  # partitions whose leftovers are merged together
CLOSING = 2  # id behind every document
CACHE = 1 << 20  # distinct chunks a task remembers before it starts anew; it bounds memory only
LONG = 64  # bytes; longer chunks are not remembered
PART = 1 << 19  # bytes of a text that are tokenised at once
SEPARATOR = "!"
# Fixed value: the pre-tokenizer pattern for which chunks are independent.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)  # ASCII digits, punctuation and symbols
_MARK[0x21:0x7F] = ~_LETTER[0x21:0x7F]
_APOSTROPHE = 0x27


def read_vocabulary(path: str) -> str:
    """Text of a ``tokenizers`` file, read on the driver and shipped with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def chunked(vocabulary: str) -> bool:
    """Whether texts of this vocabulary may be encoded chunk by chunk."""
    spec = json.loads(vocabulary)
    kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (kinds == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": SPLIT}
            and first.get("behavior") == "Removed")


class Encoder:
    """Token ids of texts, made once per task."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.by_chunk = chunked(vocabulary)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.separator = self.whole(SEPARATOR)[0]
        self.forget()

    def forget(self):
        self.mask = np.uint64((CACHE * 4) - 1)
        self.keys, self.entry = np.zeros(CACHE * 4, np.uint64), np.full(CACHE * 4, -1, np.int32)
        self.entries, self.filled = 0, 0
        self.start, self.size, self.pool = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int32)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 if unknown."""
        at = (hashes & self.mask).astype(np.int64)
        out = np.where(self.keys[at] == hashes, self.entry[at], -1)
        todo = np.flatnonzero((self.entry[at] >= 0) & (self.keys[at] != hashes))
        while len(todo):
            at[todo] = (at[todo] + 1) & int(self.mask)
            slot = at[todo]
            same = (self.keys[slot] == hashes[todo]) & (self.entry[slot] >= 0)
            out[todo[same]] = self.entry[slot[same]]
            todo = todo[~same & (self.entry[slot] >= 0)]
        return out

    def add(self, hashes: np.ndarray, flat: np.ndarray, sizes: np.ndarray):
        """Remember the ids of distinct unknown hashes."""
        first, n = self.entries, len(hashes)
        while len(self.start) < first + n:
            self.start, self.size = np.concatenate((self.start, self.start)), np.concatenate((self.size, self.size))
        while len(self.pool) < self.filled + len(flat):
            self.pool = np.concatenate((self.pool, self.pool))
        self.pool[self.filled:self.filled + len(flat)] = flat
        self.start[first:first + n] = self.filled + np.cumsum(sizes) - sizes
        self.size[first:first + n] = sizes
        self.entries, self.filled = first + n, self.filled + len(flat)
        at, left = (hashes & self.mask).astype(np.int64), np.arange(n)
        while len(left):
            slot = at[left]
            free = self.entry[slot] < 0
            self.entry[slot[free]] = first + left[free]  # of several for one slot the last stays
            self.keys[slot[free]] = hashes[left[free]]
            left = left[self.entry[at[left]] != first + left]
            at[left] = (at[left] + 1) & int(self.mask)

    def ids_of(self, raw: bytes, start: np.ndarray, end: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of chunks ``raw[start:end]`` one after the other, number per chunk).  Chunks without ASCII marks
        (not ``marked``) are encoded together, parted by a mark of its own."""
        sizes, order, found = np.zeros(len(start), np.int64), [], []
        parted, between = f" {SEPARATOR} ".encode(), self.separator
        alone = np.flatnonzero(marked)
        plain = np.flatnonzero(~marked)
        for k in range(0, len(plain), 1000):
            some = plain[k:k + 1000]
            ids = np.array(self.whole(parted.join([raw[a:b] for a, b in zip(start[some].tolist(), end[some].tolist())]).decode()), np.int32)
            cut = np.flatnonzero(ids == between)
            if len(cut) != len(some) - 1:  # a character that normalises to the mark: encode one by one
                alone = np.concatenate((alone, some))
                continue
            sizes[some] = np.diff(np.concatenate(([-1], cut, [len(ids)]))) - 1
            order.append(some)
            found.append(np.delete(ids, cut))
        if len(alone):
            chunks = [raw[a:b].decode() for a, b in zip(start[alone].tolist(), end[alone].tolist())]
            each = [x.ids for x in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
            sizes[alone] = [len(x) for x in each]
            order.append(alone)
            found.append(np.array([i for x in each for i in x], np.int32))
        if not order:
            return np.zeros(0, np.int32), sizes
        order, found = np.concatenate(order), np.concatenate(found)
        of, at = sizes[order], np.zeros(len(start), np.int64)
        at[order] = np.cumsum(of) - of
        return found[np.repeat(at - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(found))], sizes

    def slice_ids(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a slice, number of ids per text)."""
        n, size = len(at) - 1, len(data)
        low = tv.LOWER[data]
        space, letter, mark = _SPACE[data], _LETTER[data], _MARK[data]
        border = np.zeros(size + 1, bool)
        border[at] = True
        cut = (space[1:] != space[:-1]) | border[1:size] | (letter[:-1] & mark[1:]) | (
            mark[:-1] & letter[1:] & (data[:-1] != _APOSTROPHE))
        begin, stop = ~space, ~space
        begin[1:] &= cut
        stop[:-1] &= cut
        start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        doc = np.searchsorted(at, start, "right") - 1
        up, down = tv._powers(size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(tv._BYTE[low] * up[:size], out=total[1:])
        hashes = tv.mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        hashes[end - start > LONG] = 0  # not remembered
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        entry = self.find(distinct)
        unknown = np.flatnonzero((entry < 0) & (distinct != 0))
        if self.entries + len(unknown) > CACHE:
            self.forget()
            entry = self.find(distinct)
            unknown = np.flatnonzero(distinct != 0)
        raw = low.tobytes()
        marks = np.concatenate(([0], np.cumsum(mark)))
        marked = marks[end] > marks[start]
        new = where[unknown]
        self.add(distinct[unknown], *self.ids_of(raw, start[new], end[new], marked[new]))
        entry[unknown] = np.arange(self.entries - len(unknown), self.entries)
        entry = entry[inverse]
        first, sizes, pool = self.start[entry], self.size[entry], self.pool
        long = np.flatnonzero(hashes == 0)
        if len(long):
            found, sizes[long] = self.ids_of(raw, start[long], end[long], marked[long])
            pool = np.concatenate((pool[:self.filled], found))
            first[long] = self.filled + np.cumsum(sizes[long]) - sizes[long]
        behind = np.cumsum(sizes)
        ids = pool[np.repeat(first - (behind - sizes), sizes) + np.arange(behind[-1] if len(behind) else 0)]
        return ids, np.bincount(doc, weights=sizes, minlength=n).astype(np.int64)

    def text_ids(self, data: np.ndarray) -> np.ndarray:
        """Ids of one text, tokenised in parts that end behind white space."""
        out, a = [], 0
        while a < len(data):
            b = min(a + PART, len(data))
            if b < len(data):
                back = np.flatnonzero(_SPACE[data[a:b]])
                while not len(back) and b < len(data):  # one chunk longer than a part
                    c, b = b, min(b + PART, len(data))
                    back = np.flatnonzero(_SPACE[data[c:b]]) + (c - a)
                b = a + int(back[-1]) + 1 if len(back) else len(data)
            part = data[a:b]
            raw = part.tobytes()
            if any(s in raw for s in self.special):
                out.append(np.array(self.whole(raw.decode()), np.int32))
            else:
                out.append(self.slice_ids(part, np.array([0, len(part)]))[0])
            a = b
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def documents(self, column):
        """Yield the ids of each text of a string column, the closing id behind them."""
        if not self.by_chunk:
            for first in range(0, len(column), 64):
                for x in self.tokenizer.encode_batch_fast([t or "" for t in column.slice(first, 64).to_pylist()], add_special_tokens=False):
                    yield np.array([*x.ids, CLOSING], "<u4")
            return
        for _, data, at in tv.slices(column):
            raw = data.tobytes()
            if len(at) == 2 or any(s in raw for s in self.special):
                for a, b in zip(at[:-1], at[1:]):
                    yield np.concatenate((self.text_ids(data[a:b]), [CLOSING])).astype("<u4")
                continue
            ids, count = self.slice_ids(data, at)
            closed = np.full(len(ids) + len(count), CLOSING, "<u4")
            closed[np.arange(len(ids)) + np.repeat(np.arange(len(count)), count)] = ids
            yield from np.split(closed, np.cumsum(count + 1)[:-1])


class Windows:
    """Open windows of one partition.  ``place`` returns the pieces of a document as (start, length, window, offset);
    ``closed`` holds windows that became final since the last ``drain``."""

    def __init__(self, size: int, most: int, min_piece: int):
        self.size, self.most, self.min_piece = size, most, min_piece
        self.open: list[tuple[int, int]] = []  # (free, window), ordered
        self.next, self.closed = 0, []

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def _put(self, free: int, window: int):
        if free:
            bisect.insort(self.open, (free, window))
        else:
            self.closed.append(window)

    def place(self, n: int) -> list[tuple[int, int, int, int]]:
        out, at = [], 0
        while n - at >= self.size:
            window = self._new()
            out.append((at, self.size, window, 0))
            self.closed.append(window)
            at += self.size
        while at < n:
            rest = n - at
            i = bisect.bisect_left(self.open, (rest, -1))
            if i == len(self.open):
                if len(self.open) < self.most:
                    window = self._new()
                    out.append((at, rest, window, 0))
                    self._put(self.size - rest, window)
                    break
                free, window = self.open.pop(0)  # the fullest
                self.closed.append(window)
                if free >= self.min_piece:
                    out.append((at, free, window, self.size - free))
                    at += free
                continue
            free, window = self.open.pop(i)
            out.append((at, rest, window, self.size - free))
            self._put(free - rest, window)
            break
        return out

    def drain(self) -> list[int]:
        out, self.closed = self.closed, []
        return out


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def merge(lengths: list[int], size: int, min_piece: int) -> list[list[tuple[int, int, int]]]:
    """Merge leftover windows: sequences of (window, from, to) spans that hold every token of every window once."""
    bins: list[list[tuple[int, int, int]]] = []
    free: list[tuple[int, int]] = []
    for w in sorted(range(len(lengths)), key=lambda w: (-lengths[w], w)):
        i = bisect.bisect_left(free, (lengths[w], -1))
        room, b = free.pop(i) if i < len(free) else (size, len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append((w, 0, lengths[w]))
        bisect.insort(free, (room - lengths[w], b))
    bins = [bins[b] for _, b in free]  # fullest first
    used = [size - room for room, _ in free]
    i, j = 0, len(bins) - 1
    while i < j:
        gap = size - used[i]
        if gap < min_piece:
            i += 1
            continue
        w, a, b = bins[j].pop()
        cut = max(a, b - gap)
        bins[i].append((w, cut, b))
        used[i] += b - cut
        used[j] -= b - cut
        if cut > a:
            bins[j].append((w, a, cut))
        if not bins[j]:
            j -= 1
    bins = [b for b in bins if b]
    if not bins or size - used[i] < min_piece:
        return bins
    last, out = bins.pop(i), bins
    for n in powers_of_two(used[i]):
        part = []
        while n:
            w, a, b = last.pop(0)
            take = min(n, b - a)
            part.append((w, a, a + take))
            if a + take < b:
                last.insert(0, (w, a + take, b))
            n -= take
        out.append(part)
    return out


def _schema(id_type) -> T.StructType:
    return T.StructType([T.StructField("id", id_type), *(T.StructField(c, T.LongType()) for c in (
        "start", "length", "doc_tokens", "sequence_id", "offset")), T.StructField("ids", T.BinaryType())])


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         open_windows: int = OPEN, min_piece: int = MIN_PIECE) -> DataFrame:
    """One row per piece: ``id_col``, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned
    32-bit).  Sequences are shorter than ``size`` only by less than ``min_piece``, or to a power of two."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = _schema(base.schema["id"].dataType)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, windows = Encoder(vocabulary), Windows(size, open_windows, min_piece)
        held: dict[int, list] = {}
        kinds = None

        def rows(pieces, leftover):
            cols = list(zip(*pieces)) or [[]] * 7
            return pa.record_batch([pa.array(cols[0], kinds), *(pa.array(c, pa.int64()) for c in cols[1:6]), pa.array(cols[6], pa.binary()),
                                    pa.array([part] * len(pieces), pa.int64()), pa.array([leftover] * len(pieces), pa.bool_())],
                                   names=[*schema.names, "part", "leftover"])

        for batch in batches:
            kinds = batch.schema.field(0).type
            ready, weight = [], 0
            for key, ids in zip(batch.column(0).to_pylist(), encoder.documents(batch.column(1))):
                for start, length, window, offset in windows.place(len(ids)):
                    held.setdefault(window, []).append(
                        (key, start, length, len(ids), 2 * (part << 24 | window), offset, ids[start:start + length].tobytes()))
                for window in windows.drain():
                    ready += held.pop(window)
                    weight += size
                if weight > 1 << 18:
                    yield rows(ready, False)
                    ready, weight = [], 0
            if ready:
                yield rows(ready, False)
        left = [p for window in sorted(held) for p in held[window]]
        if left:
            yield rows(left, True)

    placed = T.StructType([*schema.fields, T.StructField("part", T.LongType()), T.StructField("leftover", T.BooleanType())])
    pieces = written(base.mapInArrow(run, placed), "packed", compression="zstd")

    def merge_group(table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        rows, group = table.select(schema.names).to_pylist(), table.column("part")[0].as_py() // MERGED
        held: dict[int, list] = {}
        for r in rows:
            held.setdefault(r["sequence_id"], []).append(r)
        groups = list(held.values())
        out: list[dict] = []
        for k, spans in enumerate(merge([sum(r["length"] for r in g) for g in groups], size, min_piece)):
            filled = 0
            for w, a, b in spans:
                for r in groups[w]:
                    lo, hi = max(a, r["offset"]), min(b, r["offset"] + r["length"])
                    if lo >= hi:
                        continue
                    skip = lo - r["offset"]
                    out.append(r | {"start": r["start"] + skip, "length": hi - lo, "sequence_id": 2 * (group << 24 | k) + 1, "offset": filled,
                                    "ids": r["ids"][4 * skip:4 * (skip + hi - lo)]})
                    filled += hi - lo
        return pa.table({c: pa.array([r[c] for r in out], table.schema.field(c).type) for c in schema.names})

    merged = (pieces.where("leftover").drop("leftover").withColumn("grp", F.floor(F.col("part") / MERGED))
              .groupBy("grp").applyInArrow(lambda t: merge_group(t), schema))
    final = pieces.where("not leftover").select(*schema.names).unionByName(merged)
    return final.select(F.col("id").alias(id_col), *schema.names[1:])
