"""Packing: every id in exactly one piece, sequences full or powers of two, against the tokenizer itself."""

import collections

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabmill.llm import packing, queries
from tests.conftest import SF_SMALL

VOCABULARY = packing.read_vocabulary(queries.tokenizer_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(VOCABULARY)


def _direct(encoder, text):
    return [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, packing.CLOSING]


TEXTS = ["", None, "It's a TEST, isn't it?", "'split .'s !'", "áb ≠ x", "x <|endoftext|> y <|STARTOFTEXT|>", "1⃣2 42nd a1b2",
         "tab\tnew\nline\r\nv\x0bt f\x0cf nul\x00 esc\x1b nel\x85nb sp  em", "; ; ` ` K k", "café ÉCOLE İstanbul ΣΣ",
         "你好世界 \U0001f600\U0001f3fd!!—.”", "! !! !a a! ! !", "w" * 300 + " " + "!?" * 100, "<|endoftext|>", "   \n "]


def test_chunks_give_the_tokenizers_ids(encoder):
    assert encoder.by_chunk
    got = [x.tolist() for x in encoder.documents(pa.array(TEXTS, pa.string()))]
    assert got == [_direct(encoder, t) for t in TEXTS]
    again = [x.tolist() for x in encoder.documents(pa.array(TEXTS[::-1], pa.string()))]
    assert again == got[::-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abAB'.!?<|>1 \n\t") + ["́", "̸", "é", "—", ";", "世", "\x1c", "\x85"]), max_size=30), max_size=6))
def test_any_text_gives_the_tokenizers_ids(encoder, texts):
    got = [x.tolist() for x in encoder.documents(pa.array(texts, pa.string()))]
    assert got == [_direct(encoder, t) for t in texts]


def test_long_texts_in_parts_and_a_full_memory(encoder, monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    monkeypatch.setattr(packing.tv, "SLICE_BYTES", 60)
    long = " ".join(f"word{i} it's. " + "x" * (i % 80) for i in range(120))
    assert next(iter(encoder.documents(pa.array([long])))).tolist() == _direct(encoder, long)
    monkeypatch.setattr(packing, "CACHE", 16)
    small = packing.Encoder(VOCABULARY)
    texts = [f"alpha{i} beta{i % 3} gamma!" for i in range(40)]
    assert [x.tolist() for x in small.documents(pa.array(texts))] == [_direct(encoder, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 6), st.integers(1, 8))
def test_windows_hold_every_token_once(lengths, most, least):
    windows, held, closed = packing.Windows(32, most, least), collections.defaultdict(int), set()
    for n in lengths:
        at = 0
        for start, length, window, offset in windows.place(n):
            assert start == at and offset == held[window] and window not in closed
            held[window] += length
            at += length
        assert at == n
        closed |= set(windows.drain())
        assert len(windows.open) <= most
    assert all(32 - held[w] < least for w in closed) and all(v <= 32 for v in held.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=40), st.integers(1, 8))
def test_merging_keeps_every_token_and_leaves_powers_of_two(lengths, least):
    out = packing.merge(lengths, 32, least)
    seen = collections.Counter()
    for spans in out:
        total = sum(b - a for _, a, b in spans)
        assert 0 < total <= 32 and (32 - total < least or total & (total - 1) == 0)
        for w, a, b in spans:
            assert a < b
            seen.update((w, i) for i in range(a, b))
    assert seen == collections.Counter((w, i) for w, n in enumerate(lengths) for i in range(n))


def _check(rows, docs, encoder, size=4096, least=packing.MIN_PIECE):
    """Every document's ids are rebuilt from its pieces; offsets are gapless."""
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, texts in docs.items():
        want = collections.Counter(tuple(_direct(encoder, t)) for t in texts)
        if len(texts) == 1:
            pieces = sorted(by[key], key=lambda r: r.start)
            ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces])
            assert tuple(ids) in want and [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]]
            assert all(r.doc_tokens == len(ids) for r in pieces)
        assert sum(r.length for r in by[key]) == sum(len(k) * n for k, n in want.items())
    for rs in sequences.values():
        rs.sort(key=lambda r: r.offset)
        total = sum(r.length for r in rs)
        assert [r.offset for r in rs] == [0, *np.cumsum([r.length for r in rs])[:-1]]
        assert total <= size and (size - total < least or total & (total - 1) == 0)


def test_pieces_rebuild_documents(spark, encoder):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(40)  # leftovers of several merge groups
    rows = packing.pack(docs, VOCABULARY).collect()
    _check(rows, {r.doc_id: [r.text] for r in docs.collect()}, encoder)


def test_defined_cases(spark, encoder):
    rows = [(1, None, "z"), (2, "", "z"), (3, "Same text", "y"), (3, "Same text", "y"), (None, "no id", "x"), (None, None, "x"), (4, "long " * 9000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").withColumnRenamed("doc_id", "doc_id").repartition(3)
    got = packing.pack(docs, VOCABULARY)
    assert got.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    by = collections.defaultdict(list)
    for k, t, _ in rows:
        by[k].append(t)
    _check(got.collect(), by, encoder)
    assert packing.pack(docs.limit(0), VOCABULARY).count() == 0


def test_another_vocabulary_is_encoded_whole(spark):
    other = packing.read_vocabulary(queries.tokenizer_path("byte_bpe_50k.json"))
    coder = packing.Encoder(other)
    assert not coder.by_chunk
    docs = spark.createDataFrame([(1, " Two  words"), (2, None)], "doc_id long, text string")
    _check(packing.pack(docs, other).collect(), {1: [" Two  words"], 2: [None]}, coder)
