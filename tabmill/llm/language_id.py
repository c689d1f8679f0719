"""Language identification by cross-parsing entropy.

Per language, a suffix automaton of a bounded sample of labelled text recognises every substring of that
text.  A text is parsed greedily into phrases, each the longest match in the automaton (or one unseen
letter); ``phrases * log2(sample length) / text length`` estimates its cross entropy, and the language
needing the fewest normalised phrases wins.

The winner is only the nearest of the languages learned.  Whether a text is written in it at all is told by :func:`known_limits`: bits per
character that labelled texts of the language, which the automaton has not seen, need at most at that length.

The parse walks all pieces of a batch in step: one array gather per character position for all texts
and languages.  Texts are cut into pieces of ``PIECE`` letters for this, alike for every language; every
letter of the whole text is parsed.

Defined cases: null, empty or letterless texts give ``und`` with score 0; so does a model without any
labelled text; ties go to the language first in name order; repeated rows are predicted alike; an empty
table gives an empty result; languages are whatever non-null ``lang`` values the training rows carry.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import with_fields

ROWS = 32  # training texts per language at most
CHARS = 1000  # characters of each at most: the sample is bounded by ROWS * CHARS per language
ALPHABET = 64  # code 0: anything but a letter; 1-47: frequent letters; 48-62: the others, hashed; 63: text border
DIRECT = 47
PIECE = 512
SHARPNESS = 8.0  # score = softmax of -SHARPNESS * bits per character
LIMIT_ROWS = 96  # further labelled texts per language that set its limits
LIMIT_WINDOWS = 12  # windows of each length from each of them
SHORTEST = 4  # characters; shorter texts fit any language
SLACK = 1.65  # limits are this much above what nearly all of those windows need (some hold codes, names or addresses)
QUANTILE = 0.95


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 4, equal to 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", order_col: str = "doc_id",
                    rows: int = ROWS, chars: int = CHARS) -> dict[str, list[str]]:
    """At most ``rows`` texts of at most ``chars`` characters per language, drawn by hashed id.
    The row limit is applied within every task before anything is shuffled."""
    t = docs.select(F.col(lang_col).alias("lang"), F.substring(text_col, 1, chars).alias("text"),
                    F.xxhash64(F.col(order_col), F.lit(17)).alias("h")).where("lang is not null and text is not null")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    out: dict[str, list[str]] = {}
    for r in t.withColumn("rank", rank).where(F.col("rank") <= rows).orderBy("lang", "rank").collect():
        out.setdefault(r.lang, []).append(r.text)
    return out


def codes_table(samples: dict[str, list[str]]) -> np.ndarray:
    """Code of every code point: frequent letters of the samples have their own, others share hashed ones."""
    seen = Counter(c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha())
    own = {c: i + 1 for i, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:DIRECT])}
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            low = low if len(low) == 1 else c
            table[cp] = own.get(low) or DIRECT + 1 + ord(low) % (ALPHABET - 2 - DIRECT)
    return table


def squeeze(codes: np.ndarray) -> np.ndarray:
    """Mask that keeps letters and the first of each run of other characters."""
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return keep


def suffix_automaton(seq: list[int]) -> np.ndarray:
    """Transitions [state, code] of the suffix automaton of ``seq``; state 0 is the root, -1 means none."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in seq:
        cur = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.full((len(step), ALPHABET), -1, np.int32)
    for state, out in enumerate(step):
        for c, to in out.items():
            table[state, c] = to
    return table


def build_model(samples: dict[str, list[str]]) -> dict | None:
    """Joint transition table of all languages; row 0 is a dead state, so every phrase start shows as a failed step."""
    langs = sorted(samples)
    if not langs:
        return None
    table = codes_table(samples)
    parts, starts, bits, offset = [np.full((1, ALPHABET), -1, np.int32)], [], [], 1
    for lang in langs:
        seq: list[int] = []
        for t in samples[lang]:
            codes = table[np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)]
            seq += [ALPHABET - 1, *codes[squeeze(codes)].tolist()]
        part = suffix_automaton(seq)
        part = np.where(part >= 0, (part + offset) * ALPHABET, -1).astype(np.int32)  # states are kept times ALPHABET
        starts.append(np.where(part[0] >= 0, part[0], 0))
        bits.append(math.log2(max(2, len(seq))))
        parts.append(part)
        offset += len(part)
    return {"langs": langs, "codes": table, "step": np.concatenate(parts).ravel(), "start": np.array(starts, np.int32),
            "bits": np.array(bits)}


def phrases(model: dict, codes: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Phrases per (text, language); ``codes``: all texts in a row, ``length``: letters of each."""
    first = np.concatenate(([0], np.cumsum(length)))[:-1]
    pieces = -(-length // PIECE)
    doc = np.repeat(np.arange(len(length)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = first[doc] + nth * PIECE
    size = np.minimum(PIECE, length[doc] - nth * PIECE)
    order = np.argsort(-size, kind="stable")
    doc, begin, size = doc[order], begin[order], size[order]
    step, start = model["step"], model["start"]
    state = np.zeros((len(start), len(doc)), np.int32)
    count = np.zeros((len(start), len(doc)), np.int32)
    active = np.searchsorted(-size, -np.arange(1, PIECE + 1), "right")  # pieces with more than t letters
    for t in range(PIECE):
        m = active[t]
        if not m:
            break
        c = codes[begin[:m] + t]
        to = step.take(state[:, :m] + c)
        fail = to < 0
        count[:, :m] += fail
        state[:, :m] = np.where(fail, start[:, c], to)
    out = np.zeros((len(length), len(start)))
    for i in range(len(start)):
        out[:, i] = np.bincount(doc, weights=count[i], minlength=len(length))
    return out


def known_limits(model: dict | None, samples: dict[str, list[str]]) -> np.ndarray | None:
    """Bits per character at most of a text in each language, by the binary logarithm of its length.

    ``samples`` are labelled texts that the model has not learned from; windows of 4, 8, 16, ... characters that begin at a word, and the whole
    texts, are parsed.  A length without windows takes the limit of the one below."""
    if model is None:
        return None
    limits = np.full((len(model["langs"]), 32), np.inf)
    for i, lang in enumerate(model["langs"]):
        windows, bucket = [], []
        for text in samples.get(lang, []):
            codes = model["codes"][np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
            codes = codes[squeeze(codes)]
            begins = np.flatnonzero(np.concatenate(([True], codes[:-1] == 0)) & (codes != 0)) if len(codes) else np.zeros(0, int)
            for b in range(int(math.log2(SHORTEST)), 10):
                fit = begins[begins + (1 << b) <= len(codes)]
                for a in fit[np.linspace(0, len(fit) - 1, min(LIMIT_WINDOWS, len(fit))).astype(int)] if len(fit) else ():
                    windows.append(codes[a:a + (1 << b)])
                    bucket.append(b)
        if not windows:
            continue
        length, bucket = np.array([len(w) for w in windows]), np.array(bucket)
        bits = phrases(model, np.concatenate(windows), length)[:, i] * model["bits"][i] / length
        last = np.inf
        for b in range(32):
            own = bits[bucket == b]
            if len(own) >= 20:
                last = SLACK * float(np.quantile(own, QUANTILE))
            limits[i, b] = last
        limits[i, :int(math.log2(SHORTEST))] = np.inf
    return limits


def predict_columns(model: dict | None, column, limits: np.ndarray | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, whether it is written in that language at all) of every text of an Arrow string column."""
    langs, scores, known = [], [], []
    for _, data, at in tv.slices(column):
        n = len(at) - 1
        if model is None:
            langs += ["und"] * n
            scores.append(np.zeros(n))
            known.append(np.zeros(n, bool))
            continue
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        codes = model["codes"][np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)]
        at = lead[at]
        keep = squeeze(codes)
        border = at[:-1][at[:-1] < len(codes)]
        keep[border] = True
        total = np.concatenate(([0], np.cumsum(keep)))
        length = total[at[1:]] - total[at[:-1]]
        letters = np.concatenate(([0], np.cumsum(codes != 0)))
        letters = letters[at[1:]] - letters[at[:-1]]
        h = phrases(model, codes[keep], length) * model["bits"] / np.maximum(length, 1)[:, None]
        best = np.argmin(h, axis=1)
        weight = np.exp2(-SHARPNESS * (h - h.min(axis=1, keepdims=True)))
        score = weight[np.arange(n), best] / weight.sum(axis=1)
        langs += [model["langs"][b] if k else "und" for b, k in zip(best, letters)]
        scores.append(np.where(letters > 0, score, 0.0))
        if limits is not None:
            size = np.log2(np.maximum(length, 1)).astype(np.int64)
            known.append((letters > 0) & (h[np.arange(n), best] <= limits[best, size]))
        else:
            known.append(letters > 0)
    return (langs, np.concatenate(scores), np.concatenate(known)) if scores else (langs, np.zeros(0), np.zeros(0, bool))


def identify(docs: DataFrame, samples: dict[str, list[str]], text_col: str = "text",
             pred_col: str = "lang_pred", score_col: str = "score", known_col: str | None = None,
             others: dict[str, list[str]] | None = None) -> DataFrame:
    """``docs`` with the predicted language and its score appended (replacing columns of these names), and with ``known_col`` whether the
    text is written in that language by the limits that the texts of ``others`` set."""
    told = [c for c in (pred_col, score_col, known_col) if c]
    keep = [c for c in docs.columns if c not in told]
    base = docs.select(*keep)
    fitted = build_model(samples)
    limits = known_limits(fitted, others) if others is not None else None
    model = base.sparkSession.sparkContext.broadcast((fitted, limits))  # bounded by ROWS * CHARS per language
    at = keep.index(text_col)

    def run(batches):
        for batch in batches:
            lang, score, known = predict_columns(model.value[0], batch.column(at), model.value[1])
            values = [pa.array(lang, pa.string()), pa.array(np.round(score, 6)), pa.array(known)][:len(told)]
            yield pa.record_batch([*batch.columns, *values], names=[*batch.schema.names, *told])

    kinds = dict(zip(told, (T.StringType(), T.DoubleType(), T.BooleanType())))
    return base.mapInArrow(run, with_fields(base, **kinds))
