import itertools
import random

import numpy as np
import pytest

from tabmill.llm import ngram_jaccard as nj
from tabmill.llm.common import connected_components

SCHEMA = "doc_id long, text string, class_id string, component_id int, sig string"


def brute(rows, n, num, den):
    """(size, component) per row by comparing all pairs."""
    def shingles(t):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for sep in "\t\n\x0b\x0c\r":
            lowered = lowered.replace(sep, " ")
        w = [x for x in lowered.split(" ") if x]
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and den * len(a & b) >= num * len(a | b):
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted((d, len(s), min(groups[find(i)])) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_components(df, **kw).collect())


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "Ünï"]
    rows, k = [], 0
    passage = " ".join(rng.choice(words) for _ in range(30))
    for _ in range(14):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 40, 90]))]
        for copy in range(rng.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(words)
            t = rng.choice([" ", "\n", " \t "]).join(w)
            rows.append((k, (t.upper() if rng.random() < 0.2 else t) + (" " + passage if rng.random() < 0.3 else "")))
            k += 1
    return rows + [(900, None), (901, ""), (902, " \n "), (903, None), (904, ""), (905, "A b"), (906, "a B"), (7, rows[3][1])]


@pytest.mark.parametrize("n,num", [(4, 85), (5, 80)])
def test_components_match_all_pairs(spark, n, num):
    rows = corpus()
    assert run(spark, rows, n=n, num=num, den=100) == brute(rows, n, num, 100)


def test_tiled_blocks_and_frequent_columns(spark, monkeypatch):
    """Small limits send most columns through families and tiles; the result must not change."""
    for name, value in (("BUCKET", 3), ("TILE", 4), ("HOT", 5), ("TILE_SHINGLES", 150)):
        monkeypatch.setattr(nj, name, value)
    rows = corpus()
    assert run(spark, rows, n=4, num=85, den=100) == brute(rows, 4, 85, 100)


def test_empty_table(spark):
    assert run(spark, [], n=4, num=85, den=100) == []


def test_null_ids(spark):
    got = run(spark, [(None, "a b c d e")], n=4)
    assert got == [(None, 2, None)]


def test_block_links_span_components():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(60)]
    sig = np.arange(100, 160)
    a, b = nj.block_links(sig, sets, 70, 100)
    root = {int(s): int(s) for s in sig}

    def find(root, x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a, b):
        root[find(root, int(x))] = find(root, int(y))
    want = {int(s): int(s) for s in sig}
    for i, j in itertools.combinations(range(60), 2):
        o = len(np.intersect1d(sets[i], sets[j]))
        if 100 * o >= 70 * (len(sets[i]) + len(sets[j]) - o):
            want[find(want, int(sig[i]))] = find(want, int(sig[j]))
    same = lambda r: {frozenset(s for s in r if find(r, s) == find(r, x)) for x in r}
    assert same(root) == same(want)


def test_connected_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
