"""License scan, decontamination, fingerprints: brute force on small tables and defined cases."""

import hashlib
import re

import numpy as np
import pytest

from tabmill.llm import decontaminate as d
from tabmill.llm import licenses as lic
from tabmill.llm import spotsigs as s
from tests.conftest import SF_MID, SF_SMALL


def plain(t):
    return [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]


def licenses_by_hand(rows, templates=None):
    """(id, license, first word): every window of every text against every template."""
    out = {}
    for name, body in (templates or lic.TEMPLATES).items():
        w = plain(body)
        n = min(lic.SHINGLE, len(w))
        own = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
        numbered = {g for g in own if any(any(c.isdigit() for c in x) for x in g)}
        stride = next(x for x in (16 * 4 ** k if k < 3 else 256 * 2 ** (k - 2) for k in range(20)) if len(own) + lic.SHINGLE - 1 <= x)
        for key, text in rows:
            t = plain(text)
            windows = {}
            for i in range(len(t) - n + 1):
                if tuple(t[i:i + n]) in own:
                    for k in {i // stride, i // stride - 1} - {-1}:
                        windows.setdefault(k, {}).setdefault(tuple(t[i:i + n]), i)
            first = [min(x.values()) for x in windows.values() if len(x) >= 0.8 * len(own) and numbered <= set(x)]
            if first:
                out[key, name] = min([*first, *([out[key, name]] if (key, name) in out else [])])
    return {(*k, v) for k, v in out.items()}


def _found(df, **kw):
    rows = lic.scan(df, **kw).collect()
    assert len(rows) == len({(r.doc_id, r.license) for r in rows})
    return {(r.doc_id, r.license, r.first_word) for r in rows}


def test_licenses_match_all_templates(spark):
    filler = " ".join(f"w{i}" for i in range(400))
    edited = lic.TEMPLATES["MIT-grant"].replace("free of charge", "at no charge")
    rows = [(1, None), (2, ""), (3, "MIT License"), (4, filler + " " + lic.TEMPLATES["MIT-grant"].upper() + " " + filler), (5, filler + "\n" + edited),
            (6, " ".join(lic.TEMPLATES.values())), (7, filler * 3 + lic.TEMPLATES["CC-BY-NC-4.0"]), (None, lic.TEMPLATES["MIT"]), (7, filler),
            (8, lic.TEMPLATES["MIT-line"] + " " + lic.TEMPLATES["CC-BY-4.0"]), (9, "a b c " + lic.TEMPLATES["Apache-2.0"] + " " + lic.TEMPLATES["MIT-line"])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    got = _found(df)
    assert got == licenses_by_hand(rows)
    assert {x for x in got if x[0] in (8, 9)} == {(8, "MIT-line", 0), (8, "CC-BY-4.0", 8), (9, "Apache-2.0", 3), (9, "MIT-line", 11)}
    assert lic.scan(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        lic.scan(df, templates={"x": " - "})


def test_versions_and_short_tags(spark):
    rows = [(i, f"x y {t} z") for i, t in enumerate([
        "This work is licensed under the GNU General Public License, version 2.", "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: MIT", "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: Apache-2.0", "Licensed under the Apache License, Version 1.1.", "SPDX-License-Identifier: Other"])]
    got = _found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == licenses_by_hand(rows)
    assert {(i, k) for i, k, _ in got} == {(0, "GPL-2.0"), (1, "GPL-3.0"), (2, "LGPL-2.1"), (3, "SPDX-MIT"), (4, "SPDX-GPL-2.0-only"), (5, "SPDX-Apache-2.0")}
    assert all(f == 2 for *_, f in got)


def test_templates_of_any_length(spark):
    rng = np.random.default_rng(2)
    own = {f"t{n}": " ".join(f"v{x}" for x in rng.integers(0, 10_000, n)).replace("v", "w") for n in (1, 2, 5, 300, 1500, 6000)}
    own = {k: re.sub(r"\d+", lambda m: "".join(chr(97 + int(c)) for c in m[0]), v) for k, v in own.items()}
    rows = [(i, f"q q q {v} q q") for i, v in enumerate(own.values())] + [(9, own["t6000"][: len(own["t6000"]) * 9 // 10]), (10, own["t1500"][: len(own["t1500"]) // 2])]
    got = _found(spark.createDataFrame(rows, "doc_id long, text string"), templates=own)
    assert got == licenses_by_hand(rows, own)
    assert {(i, f"t{n}", 3) for i, n in enumerate((1, 2, 5, 300, 1500, 6000))} | {(9, "t6000", 0)} <= got


def test_licenses_of_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    want = licenses_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert want and _found(docs) == want


def test_alignment_scores_by_table():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b = rng.integers(0, 6, rng.integers(1, 12)), rng.integers(0, 6, rng.integers(1, 30))
        m = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                m[i + 1, j + 1] = max(0, m[i, j] + (d.MATCH if a[i] == b[j] else d.MISMATCH), m[i, j + 1] + d.GAP, m[i + 1, j] + d.GAP)
        assert d.align(a, b)[0] == m.max()


def test_contaminated_copies(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    w = item.split()
    filler = " ".join(f"f{i % 37}" for i in range(300))
    edited = " ".join(x if i % 6 else "changed" for i, x in enumerate(w))
    docs = [(1, f"{filler} {item.upper()}, {filler}"), (2, f"{filler} {edited} {filler}"), (3, filler), (4, None), (5, ""), (6, " ".join(w[:5]) + filler),
            (7, "\n".join(w)), (7, "\n".join(w)), (None, item), (8, "tiny item")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny item"), (5, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in d.contaminated(df, bench).collect()}
    assert set(got) == {(i, k) for i in (1, 2, 7, None) for k in (1, 5)} | {(8, 4)}
    assert got[(1, 1)].score == 1.0 and (got[(1, 1)].first_word, got[(1, 1)].last_word) == (300, 319)
    assert 0.45 <= got[(2, 1)].score < 0.9
    assert d.contaminated(df.limit(0), bench).count() == 0 and d.contaminated(df, bench.limit(0)).count() == 0


def test_repeated_and_null_item_rows(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(20)) for c in "abc")
    docs = spark.createDataFrame([(1, one), (2, "x " + two), (3, three + " y"), (None, one)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, one), (1, one), (2, one), (2, two), (None, two), (None, three), (None, None)], "item_id long, text string")
    got = d.contaminated(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=repr) == sorted([(1, 1), (1, 2), (None, 1), (None, 2), (2, 2), (2, None), (3, None)], key=repr)
    assert all(r.score == 1.0 for r in got)


def test_edited_copies_are_found_as_by_aligning_all_pairs(spark):
    rng = np.random.default_rng(3)
    common = [f"c{i}" for i in range(30)]
    items = {m: [f"r{m}x{i}" if rng.random() < 0.6 else str(rng.choice(common)) for i in range(m)] for m in (3, 5, 8, 15, 20, 30, 59)}
    docs = [" ".join(rng.choice(common, 400)) for _ in range(10)]
    for w in items.values():
        for step in (2, 3, 4, 5):
            for shift in range(step):
                changed = [f"z{i}" if i % step == shift else x for i, x in enumerate(w)]
                longer = [y for i, x in enumerate(w) for y in ([x, f"y{i}"] if i % step == shift else [x])]
                shorter = [x for i, x in enumerate(w) if i % step != shift]
                docs += [" ".join([*rng.choice(common, 150), *x, *rng.choice(common, 150)]) for x in (changed, longer, shorter)]
    names = {x: i for i, x in enumerate(sorted({x for t in docs for x in t.split()} | {x for w in items.values() for x in w}))}
    code = lambda w: np.array([names[x] for x in w])
    want = {(i, m): round(s / (d.MATCH * m), 6) for i, t in enumerate(docs) for m, w in items.items()
            if (s := d.align(code(w), code(t.split()))[0]) >= d.THRESHOLD * d.MATCH * m}
    bench = spark.createDataFrame([(m, " ".join(w)) for m, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in d.contaminated(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), bench).collect()}
    assert len(want) > 150 and got == want


def test_documents_with_benchmark_passages(spark):
    docs, bench = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "benchmark"))
    grams = {}
    for r in bench.collect():
        w = plain(r.text)
        for i in range(len(w) - 11):
            grams.setdefault(tuple(w[i:i + 12]), set()).add((r.item_id, len(w)))
    want = set()
    for r in docs.collect():
        w, hits = plain(r.text), {}
        for i in range(len(w) - 11):
            for item in grams.get(tuple(w[i:i + 12]), ()):
                hits[item] = hits.get(item, 0) + 1
        want |= {(r.doc_id, k) for (k, m), n in hits.items() if n + 11 >= 0.6 * m}
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()}
    assert want and want <= got


def spots_by_hand(text):
    """Spots as tuples of words."""
    w = plain(text)
    content = [x for x in w if x not in s.ANCHORS]
    out, k = set(), 0
    for p, x in enumerate(w):
        if x in s.ANCHORS:
            if p - k + s.CHAIN <= len(content):
                out.add((x, *content[p - k:p - k + s.CHAIN]))
            k += 1
    if not out:
        out = {tuple(content[i:i + s.CHAIN]) for i in range(len(content) - s.CHAIN + 1)}
    return out or ({("", text)} if text else set())


def jaccard(a, b):
    return round(len(a & b) / len(a | b), 6) if a | b else 1.0


def test_edit_test_by_hand(spark, monkeypatch):
    monkeypatch.setattr(s, "BUCKET_ROWS", 4)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(30).collect()]
    rows += [(1000, None), (1001, ""), (1003, "!!"), (1005, "😀é of red blue green"), (1006, "one"), (1007, "one")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, bucket int")
    got = {r.doc_id: r for r in s.edit_test(df).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for i, (doc, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = (spots_by_hand(x) for x in (text, edited, following))
        assert (r.near_edited, r.near_next) == (jaccard(a, b), jaccard(a, c))
        assert len(r.fingerprint) == 8 * len(a) and len(r.edited_fingerprint) == 8 * len(b)
    assert got[1006].fingerprint == got[1007].fingerprint and got[1000].fingerprint == got[1001].fingerprint == ""


def test_fingerprint_defined_cases(spark):
    schema = "doc_id long, text string"
    assert s.edit_test(spark.createDataFrame([], schema)).count() == 0
    one = s.edit_test(spark.createDataFrame([(1, "abcd")], schema)).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(4, 1.0)] and one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    ties = s.edit_test(spark.createDataFrame([(1, "ab"), (1, "cd"), (None, "ef"), (1, "ab")], schema)).collect()
    assert len(ties) == 4


def test_near_duplicate_pairs_by_hand(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    members, pairs = s.near_duplicates(docs, 0.7)
    first = {}
    for r in docs.collect():
        key = frozenset(spots_by_hand(r.text))
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    want = set()
    sets = [(k, v) for k, v in first.items() if k]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if min(len(a), len(b)) >= 0.69 * max(len(a), len(b)) and len(a & b) >= 0.7 * len(a | b):
                want.add((min(x, y), max(x, y)))
    assert want and {(r.a, r.b) for r in pairs.collect()} == want
    assert {r.doc_id: r.class_id for r in members.collect()} == {
        r.doc_id: first[frozenset(spots_by_hand(r.text))] for r in docs.collect()}
