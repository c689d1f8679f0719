"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of about ``FRAME_BYTES`` bytes, each with the number of units (lines) that
end in it and of code points it holds; the cumulative counts are the text's seek table.  To cut a text, only the frames that hold the two cut points
are decompressed; whole frames move to their new place as they are.  The transformed text is again a list of frames, so its length,
digest and the way back to the original are read by streaming the frames in order, one in memory at a time.

Forms: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, ``plain`` the text
itself (for empty texts, texts that contain a marker, and those outside the rate).  The cut points and the form are drawn from the SHA-256 of the seed
and the id, so they do not depend on partitions, order or retries.

Defined cases: a null text counts as empty; a null id is drawn as the empty string; rows with equal ids are transformed alike, each by its own text; a unit
longer than a frame spans several; an empty table gives an empty result; other columns than id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

FRAME_BYTES = 1 << 15
LEVEL = 3
BATCH_BYTES = 1 << 20  # compressed bytes after which a task hands rows on
SEED = 7
MARKERS = ("<P>", "<S>", "<M>")  # fixed values of the format
_PREFIX, _SUFFIX, _MIDDLE = (m.encode() for m in MARKERS)
_ORDER = {"psm": (_PREFIX, _SUFFIX, _MIDDLE), "spm": (_SUFFIX, _PREFIX, _MIDDLE)}

_FRAMES = T.ArrayType(T.StructType([T.StructField("units", T.LongType()), T.StructField("chars", T.LongType()),
                                    T.StructField("data", T.BinaryType())]))
_ARROW_FRAMES = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())]))


def code_points(data: bytes) -> int:
    """Number of code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def frames_of(data: bytes, compress) -> list[tuple[int, int, bytes]]:
    """(units that end in the frame, code points, compressed bytes) of each frame of a text.  Frames end behind
    a line where one ends in their last half, else between two characters."""
    out, a = [], 0
    while a < len(data):
        b = min(a + FRAME_BYTES, len(data))
        if b < len(data):
            line = data.rfind(b"\n", a + FRAME_BYTES // 2, b) + 1
            if line:
                b = line
            while b > a and data[b] & 0xC0 == 0x80:
                b -= 1
        part = data[a:b]
        units = part.count(b"\n") + (b == len(data) and not part.endswith(b"\n"))
        out.append((units, code_points(part), compress(part)))
        a = b
    return out


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, marked, frames): every text as independent frames with the counts that make up its seek table;
    ``marked`` tells whether the text holds a marker.  Written once; any number of transformations read it."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marked = F.lit(False)
    for m in MARKERS:
        marked = marked | F.contains("text", F.lit(m))
    base = base.select("id", marked.alias("marked"), "text")
    schema = T.StructType([*base.schema.fields[:2], T.StructField("frames", _FRAMES)])

    def run(batches):
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            texts, first, rows, weight = batch.column(2).cast(pa.large_binary()), 0, [], 0
            for i, text in enumerate(texts):
                rows.append([{"units": u, "chars": c, "data": z} for u, c, z in frames_of(text.as_py(), compress)])
                weight += sum(len(f["data"]) for f in rows[-1])
                if weight > BATCH_BYTES or i + 1 == len(texts):
                    yield pa.record_batch([batch.column(0).slice(first, len(rows)), batch.column(1).slice(first, len(rows)),
                                           pa.array(rows, _ARROW_FRAMES)], names=["id", "marked", "frames"])
                    first, rows, weight = i + 1, [], 0

    return written(base.mapInArrow(run, schema), "frames")


def draws(key, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the SHA-256 of ``seed:id``."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


class Seek:
    """Cuts of one stored text."""

    def __init__(self, frames: list[dict], compress, decompress):
        self.frames, self.compress, self.decompress = frames, compress, decompress
        self.units = np.cumsum([0, *(f["units"] for f in frames)])
        self.chars = np.cumsum([0, *(f["chars"] for f in frames)])

    def find(self, unit: int) -> tuple[int, int]:
        """(frame, byte in it) behind the first ``unit`` units."""
        if unit == 0:
            return 0, 0
        k = int(np.searchsorted(self.units, unit, "left")) - 1  # the frame in which that unit ends
        if unit == self.units[-1]:
            return len(self.frames), 0
        data, nth = np.frombuffer(self.open(k), np.uint8), unit - int(self.units[k])
        end = int(np.flatnonzero(data == 10)[nth - 1]) + 1
        return (k, end) if end < len(data) else (k + 1, 0)

    def open(self, k: int) -> bytes:
        return self.decompress(self.frames[k]["data"])

    def chars_before(self, at: tuple[int, int]) -> int:
        k, byte = at
        return int(self.chars[k]) + (code_points(self.open(k)[:byte]) if byte else 0)

    def span(self, a: tuple[int, int], b: tuple[int, int]) -> list[bytes]:
        """Frames of the text from ``a`` to ``b``: only the frames that a cut divides are coded anew."""
        out, k = [], a[0]
        while k < b[0] or (k == b[0] and b[1]):
            lo, hi = a[1] if k == a[0] else 0, b[1] if k == b[0] else None
            out.append(self.frames[k]["data"] if not lo and hi is None else self.compress(self.open(k)[lo:hi]))
            k += 1
        return out


def transform(stored: DataFrame, id_name: str = "doc_id", fim_percent: int = 100, spm_percent: int = 50, seed: int = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every stored text; ``output`` holds the frames of the
    transformed text in order.  The counts are null for plain texts."""
    id_type = stored.schema["id"].dataType
    schema = T.StructType([T.StructField(id_name, id_type), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.ArrayType(T.BinaryType()))])
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary()))

    def run(batches):
        import zstandard

        compress, decompress = zstandard.ZstdCompressor(level=LEVEL).compress, zstandard.ZstdDecompressor().decompress
        mark = {m: compress(m) for m in (_PREFIX, _SUFFIX, _MIDDLE)}

        def one(key, marked, frames):
            n = sum(f["units"] for f in frames)
            h1, h2, h3, h4 = draws(key, seed)
            if not frames or marked or h3 % 100 >= fim_percent:
                return n, "plain", None, None, [f["data"] for f in frames]
            low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
            seek = Seek(frames, compress, decompress)
            a, b, end = seek.find(low), seek.find(high), (len(frames), 0)
            form = "spm" if h4 % 100 < spm_percent else "psm"
            part = {_PREFIX: seek.span((0, 0), a), _MIDDLE: seek.span(a, b), _SUFFIX: seek.span(b, end)}
            before = seek.chars_before(a)
            return n, form, before, seek.chars_before(b) - before, [f for m in _ORDER[form] for f in (mark[m], *part[m])]

        for batch in batches:
            first, rows, weight = 0, [], 0
            for i, r in enumerate(zip(*(batch.column(c) for c in range(3)))):
                rows.append(one(*(v.as_py() for v in r)))
                weight += sum(map(len, rows[-1][-1]))
                if weight > BATCH_BYTES or i + 1 == batch.num_rows:
                    yield pa.record_batch([batch.column(0).slice(first, len(rows)),
                                           *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=schema.names)
                    first, rows, weight = i + 1, [], 0

    return stored.select("id", "marked", "frames").mapInArrow(run, schema)


def restored_parts(form: str, texts):
    """Pieces of the original text, in order, read from the stream of a transformed text's frames.  A marker is a frame of its
    own.  What comes before its place in the original is handed on at once; a suffix waits, compressed, for the middle."""
    import zstandard

    if form == "plain":
        yield from texts
        return
    compress, decompress = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
    expected, current, waiting = list(_ORDER[form]), None, []
    for text in texts:
        if expected and text == expected[0]:
            current = expected.pop(0)
        elif current == _SUFFIX:
            waiting.append(compress(text))
        else:
            yield text
    for z in waiting:
        yield decompress(z)


def digests(transformed: DataFrame) -> DataFrame:
    """``transformed`` with ``output`` replaced by output_sha256 and restored_sha256 (lower-case hex): frames are streamed
    in order through both hashes, the second one over the text rebuilt from the output and its form."""
    fields = [f for f in transformed.schema.fields if f.name != "output"]
    base = transformed.select(*[f.name for f in fields], "output")
    schema = T.StructType([*fields, T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType())])
    at = [f.name for f in fields].index("form")

    def run(batches):
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress

        def one(form, frames):
            out, back = hashlib.sha256(), hashlib.sha256()

            def stream():
                for z in frames:
                    text = decompress(z)
                    out.update(text)
                    yield text

            for text in restored_parts(form, stream()):
                back.update(text)
            return out.hexdigest(), back.hexdigest()

        for batch in batches:
            both = [one(f.as_py(), o.as_py()) for f, o in zip(batch.column(at), batch.column(len(fields)))]
            yield pa.record_batch([*batch.columns[:-1], *(pa.array(c, pa.string()) for c in (zip(*both) if both else ([], [])))],
                                  names=schema.names)

    return base.mapInArrow(run, schema)


def texts(transformed: DataFrame, text_col: str = "text") -> DataFrame:
    """``transformed`` with ``output`` replaced by the text itself (a text column, as trainers read it)."""
    fields = [f for f in transformed.schema.fields if f.name != "output"]
    base = transformed.select(*[f.name for f in fields], "output")
    schema = T.StructType([*fields, T.StructField(text_col, T.StringType())])

    def run(batches):
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = [b"".join(map(decompress, o.as_py())).decode() for o in batch.column(len(fields))]
            yield pa.record_batch([*batch.columns[:-1], pa.array(out, pa.string())], names=schema.names)

    return base.mapInArrow(run, schema)
