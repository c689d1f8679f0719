"""SentencePiece encoding and decoding with seeded merge dropout.

A merge-type vocabulary builds pieces bottom up: the agenda holds every adjacent pair that forms a piece
and always takes the best-scored, leftmost one.  With dropout, the candidate at the head of the agenda is
skipped with the rate's probability, by draws keyed by (seed, hash of the whole text, occurrence in the text); a
skipped pair stays out until one of its sides changes.  So every occurrence of a word is cut on its own, equal
texts are cut alike, and another seed cuts them otherwise.  Rate 0 gives the plain segmentation.

A run depends only on which agenda steps are skipped.  Results are kept per chunk and skipped steps, as a tree: a node's
run skips the steps on its path and no later one, and an occurrence goes down as long as its next skip falls within the run.
What is kept saves work; it never changes or bounds the segmentations.

Encoding is lossless for any text: characters outside the vocabulary, line breaks and a literal U+2581 become
byte pieces, spaces become U+2581, and one dummy space leads.  No piece has U+2581 after another character, so
chunks ``spaces + word`` are independent; the distinct chunks of a batch are merged in step, as arrays.

Defined cases: a null text has null ids and null text; the empty text has no pieces; repeated rows are encoded alike;
chunks of any length are merged (long ones one at a time, on a heap); an empty table gives an empty result; invalid
ids in decoding raise.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textvec as tv
from .common import with_fields

MARK = "▁"
VARIANTS = 1 << 64  # a text's draws are keyed by its full hash
SHORT = 48  # chunks up to this many characters are merged in step
CACHE = 250_000  # runs a task keeps before it starts anew; it bounds memory only
NEVER = np.int32(2**31 - 1)
_CHUNK = re.compile(" *[^ \n]+| +|\n")


def load_vocabulary(path: str) -> dict:
    """Pieces and scores of a SentencePiece model file with byte pieces (read on the driver, a few hundred kB)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    pieces = {sp.id_to_piece(i): i for i in normal}
    byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if any(not sp.is_byte(i) for i in byte_id):
        raise ValueError("the model has no byte pieces")
    rank = np.full(n, NEVER, np.int32)
    rank[sorted(normal, key=lambda i: (-sp.get_score(i), i))] = np.arange(len(normal))
    split = [(pieces[p[:k]], pieces[p[k:]], i) for p, i in pieces.items() for k in range(1, len(p))
             if p[:k] in pieces and p[k:] in pieces]
    raw = [b""] * n
    for p, i in pieces.items():
        raw[i] = p.replace(MARK, " ").encode()
    for b, i in enumerate(byte_id):
        raw[i] = bytes([b])
    return {"char": {p: i for p, i in pieces.items() if len(p) == 1}, "byte": np.array(byte_id, np.int32), "rank": rank,
            "pair": np.array(split, np.int64).reshape(-1, 3), "raw": raw, "known": np.array([len(r) > 0 for r in raw])}


class Coder:
    """Encoder and decoder over one vocabulary, made once per task."""

    def __init__(self, vocabulary: dict, rate: float, seed: int, variants: int = VARIANTS):
        self.char, self.byte, self.rank, self.n = vocabulary["char"], vocabulary["byte"], vocabulary["rank"], len(vocabulary["raw"])
        with np.errstate(divide="ignore"):
            self.log_kept = np.log1p(-min(rate, 1.0))
        self.rate, self.key = rate, np.uint64(seed * 0xD6E8FEB86659FD93 % (1 << 64))
        self.variants = variants if rate > 0 else 1
        left, right, made = vocabulary["pair"].T
        self._hash_pairs(left * (1 << 32) + right, made)
        self.by_rank = np.flatnonzero(self.rank < NEVER)[np.argsort(self.rank[self.rank < NEVER])]
        self.symbol = np.arange(0x110000, dtype=np.int32) + self.n
        for c, i in self.char.items():
            self.symbol[ord(c)] = i
        self.symbol[32], self.symbol[ord(MARK)] = self.char[MARK], self.n + ord(MARK)
        raw = vocabulary["raw"]
        self.length = np.array([len(r) for r in raw], np.int64)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.first = np.concatenate(([0], np.cumsum(self.length)))[:-1]
        self._forget()

    def _forget(self):
        self.known: dict = {}  # node of each chunk without skips; long chunks: of (chunk, key)
        self.count, self.filled, self.spelt, self.slots = 0, 0, 0, 0
        self.flat, self.symbol_of, self.rank_of, self.next = (np.zeros(1 << 16, np.int32) for _ in range(4))
        # of each node: its ids, its symbols, the steps of its run, its slots for later skips, the node above and the step it skips
        self.start, self.size, self.first_symbol, self.length_of, self.steps, self.slot, self.above, self.skip = (
            np.zeros(1 << 14, np.int64) for _ in range(8))

    def _hash_pairs(self, keys: np.ndarray, made: np.ndarray):
        """Open-addressing table of the pairs: a lookup is a few array gathers."""
        bits = max(4, int(len(keys) * 8).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.made = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at = (tv.mix(keys.view(np.uint64)) & self.mask).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            slot = at[left]
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[left[free]]  # of several for one slot the last stays
            self.made[slot[free]] = made[left[free]]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & int(self.mask)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece made of each pair, -1 if none."""
        keys = left.astype(np.int64) * (1 << 32) + right
        at = (tv.mix(keys.view(np.uint64)) & self.mask).astype(np.int64)
        there = self.keys[at]
        hit = there == keys
        out = np.where(hit, self.made[at], -1)
        todo = np.flatnonzero(~hit & (there >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & int(self.mask)
            there, want = self.keys[at[todo]], keys[todo]
            hit = there == want
            out[todo[hit]] = self.made[at[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece made of each pair; ranks name pieces, so the piece is by_rank[rank]."""
        made = self.joined(left, right)
        return np.where(made >= 0, self.rank[made], NEVER)

    def gap(self, key, depth: int) -> np.ndarray:
        """Steps that are kept before the next skip of each key, after ``depth`` skips: a geometric draw."""
        key = np.asarray(key, np.uint64)
        if self.rate <= 0:
            return np.full(len(key), int(NEVER), np.int64)
        u = tv.mix(tv.mix(key + self.key) + np.uint64(depth * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(11)
        return np.minimum(np.log1p(u * -(2.0**-53)) / self.log_kept, float(NEVER)).astype(np.int64)

    def skips(self, key, steps: int) -> np.ndarray:
        """The skipped steps below ``steps`` of each key, one row each, filled up with later ones."""
        out = [self.gap(key, 0)]
        while (out[-1] < steps).any():
            out.append(out[-1] + 1 + self.gap(key, len(out)))
        return np.stack(out, axis=1)

    def symbols(self, chunks: list[str]) -> np.ndarray:
        """Ids of the characters of all chunks in a row; those without a piece are numbered above the vocabulary by code point."""
        return self.symbol[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _spell(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters without a piece by their byte pieces, over sequences in a row."""
        odd = np.flatnonzero(ids >= self.n)
        if not len(odd):
            return ids, size
        spelt = [self.byte[list(chr(i).encode("utf-8", "replace"))] for i in (ids[odd] - self.n)]
        more = np.array([len(x) for x in spelt])
        width = np.ones(len(ids), np.int64)
        width[odd] = more
        out = np.repeat(ids, width)
        at = (np.cumsum(width) - width)[odd]
        out[np.repeat(at, more) + np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)] = np.concatenate(spelt)
        total = np.concatenate(([0], np.cumsum(width)))
        ends = np.concatenate(([0], np.cumsum(size)))
        return out, np.diff(total[ends])

    def merge_long(self, symbols, key: int) -> np.ndarray:
        """One chunk with the draws of ``key``, the agenda on a heap."""
        ids = [int(i) for i in symbols]
        k = len(ids)
        after, before, version = list(range(1, k + 1)), list(range(-1, k - 1)), [0] * k
        heap: list = []
        made = self.joined(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)) if k > 1 else []
        for i, m in enumerate(made):
            if m >= 0:
                heap.append((int(self.rank[m]), i, 0, i + 1, 0, int(m)))
        heapq.heapify(heap)
        key, step, depth = np.array([key], np.uint64), 0, 0
        skip = int(self.gap(key, 0)[0])

        def push(i):
            j = after[i]
            m = int(self.joined(np.array([ids[i]]), np.array([ids[j]]))[0])
            if m >= 0:
                heapq.heappush(heap, (int(self.rank[m]), i, version[i], j, version[j], m))

        while heap:
            _, i, vi, j, vj, m = heapq.heappop(heap)
            if version[i] != vi or version[j] != vj:
                continue
            step += 1
            if step > skip:
                depth += 1
                skip = step + int(self.gap(key, depth)[0])
                continue
            ids[i] = m
            version[i] += 1
            version[j] = -1
            after[i] = after[j]
            if after[i] < k:
                before[after[i]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        out, i = [], 0
        while i < k:
            out.append(ids[i])
            i = after[i]
        return np.array(out, np.int32)

    def merge_short(self, symbols: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks of equal length with the draws of each one's key.  Returns (ids in the first columns of a matrix, number of ids of each row)."""
        n, k = symbols.shape
        rank = np.full((n, k), NEVER)
        rank[:, :-1] = self.ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, k - 1)
        ids, size, _ = self.merge_in_step(symbols, rank, np.full(n, k), self.skips(key, 3 * k))
        out = np.zeros((n, k), np.int64)
        out[np.arange(k)[None, :] < size[:, None]] = ids
        return out, size

    def merge_in_step(self, symbols: np.ndarray, rank: np.ndarray, length: np.ndarray, skips: np.ndarray):
        """Chunks merged in step: every row takes the head of its own agenda each round, and skips it in the rounds given (a row each,
        ascending).  ``rank`` has the rank of each symbol with the next.  Returns (ids of all rows in a row, number of ids and of steps of each)."""
        n, k = symbols.shape
        end = n * k  # stands for no neighbour
        ids, rank = np.append(symbols.ravel().astype(np.int64), -1), np.append(rank.ravel(), NEVER)
        agenda = rank[:-1].reshape(n, k)
        alive = (np.arange(k)[None, :] < length[:, None]).ravel()
        live = np.arange(n)
        before, after = np.arange(-1, end), np.arange(1, end + 2)
        before[live * k], after[live * k + length - 1] = end, end
        skips = np.concatenate((skips, np.full((n, 1), int(NEVER))), axis=1)
        steps, due, step = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        while len(live):
            i = live * k + np.argmin(agenda[live], axis=1)
            on = rank[i] < NEVER
            if not on.all():
                steps[live[~on]] = step
                live, i = live[on], i[on]
            drop = skips[live, due[live]] == step
            step += 1
            if drop.any():
                rank[i[drop]] = NEVER
                due[live[drop]] += 1
                i = i[~drop]
            j, left = after[i], before[i]
            right = after[j]
            ids[i] = new = self.by_rank[rank[i]]
            alive[j], rank[j] = False, NEVER
            after[i], before[right] = right, i
            rank[np.concatenate((left, i))] = self.ranks(np.concatenate((ids[left], new)), np.concatenate((new, ids[right])))
        return ids[:-1][alive], alive.reshape(n, k).sum(axis=1), steps

    def learn(self, first: np.ndarray, length: np.ndarray, skips: np.ndarray, above: np.ndarray, skip: np.ndarray):
        """Merge chunks, given by their place in ``symbol_of``, with the given skips and store them as the next nodes, in order."""
        n = len(first)
        parts, sizes, steps = [], [], np.zeros(n, np.int64)
        order = np.argsort(length, kind="stable")
        for at in range(0, n, 4096):
            part = order[at:at + 4096]
            cols = np.arange(length[part[-1]])
            place = first[part][:, None] + np.minimum(cols, length[part][:, None] - 1)  # past its end, a chunk's last symbol, whose rank is NEVER
            ids, size, steps[part] = self.merge_in_step(self.symbol_of[place], self.rank_of[place], length[part], skips[part])
            parts.append(ids)
            sizes.append(size)
        ids, size = self._spell(np.concatenate(parts), np.concatenate(sizes))
        at = self._nodes(n)
        self._store(at + order, ids, size)
        at = slice(at, at + n)
        self.first_symbol[at], self.length_of[at], self.steps[at], self.above[at], self.skip[at] = first, length, steps, above, skip
        self.slot[at] = self.slots + np.cumsum(steps) - steps
        self.slots += int(steps.sum())
        self.next = grown(self.next, self.slots)

    def _nodes(self, n: int) -> int:
        """Number of the first of ``n`` further nodes."""
        names = ("start", "size", "first_symbol", "length_of", "steps", "slot", "above", "skip")
        for name in names:
            setattr(self, name, grown(getattr(self, name), self.count + n))
        self.count += n
        return self.count - n

    def _store(self, nodes: np.ndarray, ids: np.ndarray, size: np.ndarray):
        need = self.filled + len(ids)
        self.flat = grown(self.flat, need)
        self.flat[self.filled:need] = ids
        self.start[nodes] = self.filled + np.cumsum(size) - size
        self.size[nodes] = size
        self.filled = need

    def _roots(self, chunks: list[str]):
        """Store the runs without skips of new chunks."""
        length = np.array([len(c) for c in chunks])
        symbols = self.symbols(chunks)
        need = self.spelt + len(symbols)
        self.symbol_of, self.rank_of = grown(self.symbol_of, need), grown(self.rank_of, need)
        self.symbol_of[self.spelt:need] = symbols
        rank = self.ranks(symbols, np.append(symbols[1:], -1))
        rank[np.cumsum(length) - 1] = NEVER
        self.rank_of[self.spelt:need] = rank
        none = np.full(len(chunks), -1, np.int64)
        self.learn(self.spelt + np.cumsum(length) - length, length, np.zeros((len(chunks), 0), np.int64), none, none)
        self.spelt = need

    def _long(self, chunk: str, key: int) -> int:
        """Node of a long chunk with the draws of ``key``."""
        at = (chunk, key) if self.rate > 0 else chunk
        if at not in self.known:
            merged = self.merge_long(self.symbols([chunk]), key)
            ids, size = self._spell(merged, np.array([len(merged)]))
            self.known[at] = self._nodes(1)
            self._store(np.array([self.known[at]]), ids, size)
        return self.known[at]

    def _descend(self, node: np.ndarray, key: np.ndarray):
        """Replace the nodes without skips by those of each occurrence's skips."""
        at = self.gap(key, 0)
        live, depth = np.flatnonzero(at < self.steps[node]), 0
        while len(live):
            slot = self.slot[node[live]] + at[live]
            new, some = np.unique(slot[self.next[slot] == 0], return_index=True)  # 0 is no child: the first node is a chunk's own
            if len(new):
                some = live[np.flatnonzero(self.next[slot] == 0)[some]]
                above, skips, up = node[some], [at[some]], node[some]
                for _ in range(depth):
                    skips.append(self.skip[up])
                    up = self.above[up]
                first = self.count
                self.learn(self.first_symbol[above], self.length_of[above], np.stack(skips[::-1], axis=1), above, at[some])
                self.next[new] = np.arange(first, self.count)
            node[live] = self.next[slot]
            depth += 1
            at[live] += 1 + self.gap(key[live], depth)
            live = live[at[live] < self.steps[node[live]]]

    def encode(self, texts: list[str], variants: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        if self.count > CACHE:
            self._forget()
        refs, words, new, long = [], [0], [], []
        n, known = self.count, self.known
        get = known.get
        for t in texts:
            for w in _CHUNK.findall(" " + t) if t else ():
                i = get(w)
                if i is None:
                    if len(w) > SHORT:
                        long.append((len(refs), w))
                        i = 0
                    else:
                        i = known[w] = n
                        n += 1
                        new.append(w)
                refs.append(i)
            words.append(len(refs))
        if new:
            self._roots(new)
        node, count = np.array(refs, np.int64), np.diff(words)
        # the key of an occurrence: its text's key and its number in the text
        nth = np.arange(len(node)) - np.repeat(np.array(words[:-1]), count)
        key = tv.mix(np.repeat(np.array(variants, np.uint64), count) + nth.astype(np.uint64) * np.uint64(tv._SALTS[0]))
        if long:
            at = np.array([i for i, _ in long])
            node[at] = [self._long(w, int(key[i])) for i, w in long]
        if self.rate > 0 and self.count:
            self._descend(node, key)
        total = np.concatenate(([0], np.cumsum(self.size[node])))
        return gather(self.flat, self.start[node], self.size[node]), np.diff(total[words])

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(UTF-8 bytes of all texts in a row, bytes of each); the dummy space of each text is dropped."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.n or (self.length[ids] == 0).any()):
            raise ValueError("ids outside the vocabulary")
        data = gather(self.bytes, self.first[ids], self.length[ids])
        size = np.concatenate(([0], np.cumsum(self.length[ids])))[np.concatenate(([0], np.cumsum(count)))]
        keep = np.ones(len(data), bool)
        starts = size[:-1][count > 0]
        keep[starts[data[starts] == 32]] = False
        total = np.concatenate(([0], np.cumsum(keep)))[size]
        return data[keep].tobytes(), np.diff(total)


def grown(values: np.ndarray, n: int) -> np.ndarray:
    """``values`` with room for ``n`` at least, new ones 0."""
    return values if n <= len(values) else np.concatenate((values, np.zeros(n, values.dtype)))


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenate the runs ``values[start : start + size]``."""
    end = np.cumsum(size)
    if not len(end) or not end[-1]:
        return values[:0]
    return values[np.arange(end[-1]) + np.repeat(start - (end - size), size)]


def variant_of(texts: list[str], variants: int) -> list[int]:
    """Key of each text: a hash of all its bytes."""
    return [int.from_bytes(hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), "little") % variants for t in texts]


def encode(docs: DataFrame, vocabulary: dict, text_col: str = "text", ids_col: str = "ids", rate: float = 0.1,
           seed: int = 7, lossless_col: str | None = None, drop_text: bool = False) -> DataFrame:
    """``docs`` with ``ids_col`` (array<int>) appended, replacing a column of that name.  ``lossless_col`` also decodes
    the ids and compares them with the text, byte by byte; ``drop_text`` leaves the text out of the result."""
    base = docs.select(*[c for c in docs.columns if c not in (ids_col, lossless_col)])
    at = base.columns.index(text_col)
    kept = [i for i, c in enumerate(base.columns) if not (drop_text and i == at)]
    names = [base.columns[i] for i in kept] + [ids_col] + [lossless_col] * bool(lossless_col)

    def run(batches):
        coder = Coder(vocabulary, rate, seed)
        for batch in batches:
            for first, data, offsets in tv.slices(batch.column(at)):
                part = batch.slice(first, len(offsets) - 1)
                column = part.column(at)
                texts = [t or "" for t in column.to_pylist()]
                ids, count = coder.encode(texts, variant_of(texts, coder.variants))
                cuts = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
                lists = pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32)))
                if column.null_count:
                    lists = pc.if_else(column.is_valid(), lists, pa.nulls(len(lists), lists.type))
                out = [*(part.column(i) for i in kept), lists]
                if lossless_col:
                    back, size = coder.decode(ids.astype(np.int64), count)
                    ends = np.concatenate(([0], np.cumsum(size)))
                    raw = data.tobytes()
                    out.append(pa.array([back[ends[i]:ends[i + 1]] == raw[offsets[i]:offsets[i + 1]] for i in range(len(texts))], pa.bool_()))
                yield pa.record_batch(out, names=names)

    fields = {ids_col: T.ArrayType(T.IntegerType())} | ({lossless_col: T.BooleanType()} if lossless_col else {})
    return base.mapInArrow(run, with_fields(base.select(*[base.columns[i] for i in kept]), **fields))


def decode(encoded: DataFrame, vocabulary: dict, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of ``ids_col`` appended, replacing a column of that name."""
    base = encoded.select(*[c for c in encoded.columns if c != text_col])
    at = base.columns.index(ids_col)

    def run(batches):
        coder = Coder(vocabulary, 0.0, 0)
        for batch in batches:
            column = batch.column(at)
            count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            data, size = coder.decode(ids, count)
            offsets = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int64), pa.int64())
            text = pa.LargeStringArray.from_buffers(len(count), offsets.buffers()[1], pa.py_buffer(data)).cast(pa.string())
            if column.null_count:
                text = pc.if_else(column.is_valid(), text, pa.nulls(len(text), pa.string()))
            yield pa.record_batch([*batch.columns, text], names=[*batch.schema.names, text_col])

    return base.mapInArrow(run, with_fields(base, **{text_col: T.StringType()}))
