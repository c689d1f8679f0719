"""Ranked search against a score for every pair of document and item; fill-in-middle against plain string work."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabmill.llm import infill, ranked_search
from tests.conftest import SF_SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(docs, items, k=10):
    """(item, rank, doc_id, score) by scoring every pair."""
    counts = [(d, _terms(t)) for d, t in docs]
    lengths = [len(t) for _, t in counts if t]
    n, total = len(lengths), sum(lengths)
    df = {}
    for _, t in counts:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, t in counts:
            score = 0
            for w in _terms(text):
                tf = t.count(w)
                if tf:
                    m = 25 + 75 * len(t) * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d if d is not None else 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def _key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def _same(got, want):
    assert sorted(map(tuple, got), key=_key) == sorted(want, key=_key)


def test_search_equals_scoring_every_pair(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(5)
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    got = ranked_search.ranked(docs, items).collect()
    _same(got, _brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()]))


def test_ties_nulls_repeats_and_clashing_columns(spark):
    docs = [(9, "alpha beta"), (3, "Alpha, BETA!"), (3, "alpha beta"), (None, "beta alpha"), (5, None), (6, ""), (7, "..."), (8, "Été alpha1 x"),
            (2, "gamma " * 40), (1, "alpha")]
    items = [(1, "alpha alpha beta"), (1, "gamma"), (None, "Été"), (4, None), (5, "?!"), (6, "nothing")]
    d = spark.createDataFrame([(*r, "c") for r in docs], "doc_id long, text string, score string").repartition(3)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id int, text string, doc_id int")
    got = ranked_search.ranked(d, i, k=4)
    assert got.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    _same(got.collect(), _brute(docs, items, 4))
    for a, b in ((d.limit(0), i), (d, i.limit(0)), (d.where("doc_id = 5"), i)):
        assert ranked_search.ranked(a, b).collect() == []


def _random_corpus(rng, n, words):
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 12) if rng.random() < 0.9 else 60))) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_small_blocks_segments_and_parts(spark, seed, monkeypatch):
    """Segments, strata, blocks of items and parts of long texts at their smallest."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["the"] * 20
    docs, items = _random_corpus(rng, 300, words), _random_corpus(rng, 25, words)
    for name, value in (("SEGMENT_DOCS", 50), ("BLOCK_DOCS", 4), ("CELLS", 16), ("PART", 40), ("BLOCK_TERMS", 60)):
        monkeypatch.setattr(ranked_search, name, value)
    monkeypatch.setattr(ranked_search.tv, "SLICE_BYTES", 64)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = ranked_search.ranked(d, spark.createDataFrame(items, "item_id long, text string"), k=3).collect()
    _same(got, _brute(docs, items, 3))


def test_an_index_of_all_terms_gives_the_same(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    docs, item = _random_corpus(rng, 80, words), " ".join(words[:9])
    d = spark.createDataFrame(docs, "doc_id long, text string")
    totals = ranked_search.corpus_totals(d)
    assert totals == (sum(1 for _, t in docs if t), sum(len(t.split()) for _, t in docs))
    index = ranked_search.build_index(d, totals)
    asked = ranked_search.query_terms(spark.createDataFrame([(1, item)], "item_id long, text string")).orderBy("term").toArrow()
    terms, term = np.unique(asked.column("term").to_numpy().view(np.uint64), return_inverse=True)
    weight = ranked_search.weights(ranked_search.document_frequencies(index, terms), totals[0])
    entries = (np.zeros(len(term), np.int64), term, asked.column("count").to_numpy())
    got = ranked_search.search(index, terms, weight, entries, asked.column("item_id").combine_chunks()[:1], 5).collect()
    best = sorted(((r.item_id, -r.score, r.doc_id) for r in got))[:5]
    assert [(i, d, -s) for i, s, d in best] == [(i, d, s) for i, _, d, s in _brute(docs, [(1, item)], 5)]


def test_scores_beyond_exact_doubles_are_summed_as_integers(monkeypatch):
    monkeypatch.setattr(ranked_search, "EXACT", 1.0)
    ids, m = np.array([4, 2], np.int64), np.array([30, 30])
    row = next(ranked_search.stratum_rows(ids, m, np.array([0, 1]), np.array([7, 7], np.uint64), np.array([2, 2])))
    s = ranked_search.Searcher(np.array([7], np.uint64), np.array([1000]), (np.array([0]), np.array([0]), np.array([3])), 1, 1)
    assert not s.exact
    s.visit(ids, *s.open(row[0], *row[2:]))
    s.settle()
    assert [x.tolist() for x in s.best] == [[0], [3000 * (2 * 10**9 // (2000 + 240))], [2]]


def _expected(key, text, fim=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in infill.MARKERS) or h3 % 100 >= fim:
        return n, "plain", None, None, text
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _held_against(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, form string, n int").repartition(3)
    done = infill.transform(infill.store(docs), **options)
    full = sorted(map(tuple, infill.texts(done).collect()), key=_key)
    want = sorted(((k, *_expected(k, t, *options.values())) for k, t in rows), key=_key)
    assert full == want
    hashed = sorted(map(tuple, infill.digests(done).collect()), key=_key)
    assert hashed == sorted(((*x[:5], _sha(x[5]), _sha(t or "")) for x, (k, t) in (
        ((k, *_expected(k, t, *options.values())), (k, t)) for k, t in rows)), key=_key)


CASES = [(1, None), (2, ""), (3, "\n"), (4, "one line"), (5, "a\nb\n\nc\n"), (6, "a <P> b\nc"), (7, "é世\n\U0001f600\n" * 50), (8, "x" * 500), (None, "no\nid\n"),
         (9, "a\nb\nc"), (9, "a\nb\nc"), (9, "d\n" * 40), (10, "\n" * 300), (11, "\r\n a\r b\x85 c\n")]


@pytest.mark.parametrize("size", [8, 64, 1 << 15])
def test_infill_equals_string_work(spark, size, monkeypatch):
    monkeypatch.setattr(infill, "FRAME_BYTES", size)
    monkeypatch.setattr(infill, "BATCH_BYTES", 100)
    _held_against(spark, CASES + [(100 + i, f"l{i}\nm\n" * i) for i in range(40)])


def test_infill_rates_and_empty_table(spark):
    _held_against(spark, [(i, "a\nb\nc\n") for i in range(60)], fim_percent=40, spm_percent=90, seed=3)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert infill.digests(infill.transform(infill.store(empty))).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("ab\né\U0001f600"), max_size=60), st.integers(5, 40))
def test_cuts_open_only_the_cut_frames(text, size):
    old, infill.FRAME_BYTES = infill.FRAME_BYTES, size
    try:
        opened = []

        def open_frame(z):
            opened.append(z)
            return z

        frames = [{"units": u, "chars": c, "data": z} for u, c, z in infill.frames_of(text.encode(), bytes)]
    finally:
        infill.FRAME_BYTES = old
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert b"".join(f["data"] for f in frames).decode() == text and sum(f["units"] for f in frames) == len(units)
    assert sum(f["chars"] for f in frames) == len(text)
    for a in range(len(units) + 1):
        for b in range(a, len(units) + 1):
            seek = infill.Seek(frames, bytes, open_frame)
            opened.clear()
            x, y = seek.find(a), seek.find(b)
            assert b"".join(seek.span(x, y)).decode() == "".join(units[a:b])
            assert seek.chars_before(x) == len("".join(units[:a]))
            assert len(set(map(id, opened))) <= 2
