"""Language, quality and toxicity: held-out accuracy, brute-force checks of their parts, and defined cases."""

import random

import numpy as np
import pytest

from tabmill.llm import language_id as li
from tabmill.llm import quality as q
from tabmill.llm import textvec as tv
from tabmill.llm import toxicity as tox
from tests.conftest import SF_MID


def longest_match_phrases(seq, text):
    """Greedy parse by substring search."""
    s, n, i = "".join(map(chr, seq)), 0, 0
    t = "".join(map(chr, text))
    while i < len(t):
        k = 1
        while i + k <= len(t) and t[i:i + k] in s:
            k += 1
        i += max(1, k - 1)
        n += 1
    return n


def test_phrases_match_substring_search():
    rng = random.Random(1)
    samples = {x: ["".join(rng.choice(a) for _ in range(300)) for _ in range(3)] for x, a in (("aa", "abc de"), ("bb", "bcf gé"))}
    model = li.build_model(samples)
    texts = ["".join(rng.choice("abcdefg éx") for _ in range(n)) for n in (1, 7, 200, 511)]
    codes, length = [], []
    for t in texts:
        c = model["codes"][np.frombuffer(t.encode("utf-32-le"), np.uint32)]
        c = c[li.squeeze(c)]
        codes.append(c)
        length.append(len(c))
    got = li.phrases(model, np.concatenate(codes), np.array(length))
    for k, lang in enumerate(model["langs"]):
        seq = []
        for t in samples[lang]:
            c = model["codes"][np.frombuffer(t.encode("utf-32-le"), np.uint32)]
            seq += [li.ALPHABET - 1, *c[li.squeeze(c)]]
        assert [longest_match_phrases(seq, c) for c in codes] == got[:, k].tolist()


def test_language_held_out_accuracy(spark):
    from tabmill.llm.queries import op4_language_id

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = op4_language_id(spark, SF_MID).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert held and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_defined_cases(spark):
    schema = "doc_id long, text string, lang string, lang_pred int, score string"
    rows = [(1, "the cat and the dog", "en", 1, "x"), (2, "le chat et le chien", "fr", 1, "x"), (3, None, "en", 1, "x"), (4, "", None, 1, "x"),
            (5, "123 !!", "en", 1, "x"), (None, "THE DOG", None, 1, "x"), (1, "the cat and the dog", "en", 1, "x")]
    df = spark.createDataFrame(rows, schema)
    got = li.identify(df, li.training_sample(df)).select("doc_id", "lang_pred", "score").collect()
    assert [r.lang_pred for r in got] == ["en", "fr", "und", "und", "und", "en", "en"]
    assert [got[i].score for i in (2, 3, 4)] == [0.0, 0.0, 0.0]
    assert li.identify(df.limit(0), li.training_sample(df)).count() == 0
    assert {r.lang_pred for r in li.identify(df, {}).collect()} == {"und"}


def test_word_hashes_agree_across_slices(monkeypatch):
    import pyarrow as pa

    texts = ["Ab c", None, "", "c ab", "  x\ty\nz é", "ab" * 500, "d"]
    whole = [tv.Words(d, a) for _, d, a in tv.slices(pa.array(texts))]
    assert len(whole) == 1
    parts = [tv.Words(d, a) for _, d, a in tv.slices(pa.array(texts), limit=8)]
    assert len(parts) > 2
    assert np.array_equal(whole[0].hash, np.concatenate([p.hash for p in parts]))
    h = whole[0].hash
    assert h[0] == h[3] and h[1] == h[2]
    assert whole[0].count.tolist() == [2, 0, 0, 2, 4, 1, 1]


def test_quality_separates_and_draws(spark):
    from tabmill.llm.queries import op6_quality

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    rows = op6_quality(spark, SF_MID).collect()
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1
    assert sum(r.kept for r in rows) == sum(r.log_weight >= 0 for r in rows)  # k rows are drawn


def test_quality_weights_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (3, ""), (4, "b"), (4, "b")], "doc_id long, text string")
    counts = q.bucket_counts(docs)
    assert counts.sum() == 3 + 2 + 1 + 1
    ratio = np.random.default_rng(0).normal(size=q.BUCKETS)
    got = {r.doc_id: (r.log_weight, r.n_grams) for r in q.weigh(docs, ratio, 0.25, 1.0).collect()}
    one = [int(h % np.uint64(q.BUCKETS - 1)) for h in tv.Words(np.frombuffer(b"b", np.uint8), np.array([0, 1])).shingles(1)[0]]
    assert got[4] == (round(1 + ratio[one[0]] - 0.25, 6), 1)
    assert got[2] == got[3] == (1.0, 0)
    assert got[1][1] == 5


def test_kth_largest_is_exact(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.gauss(0, 1e-3), rng.gauss(0, 1e6), 1.0]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 7, 250, 499, 500):
        assert q.kth_largest(df, k, bins=16) == sorted(values, reverse=True)[k - 1]
    assert q.kth_largest(df, 0) == float("inf") and q.kth_largest(df, 501) == float("-inf")


def test_quality_draw_is_standard_gumbel_top_k(spark):
    from pyspark.sql import functions as F

    noise = spark.range(40000).agg(F.avg(q.gumbel("id")).alias("mean"), F.var_samp(q.gumbel("id")).alias("var")).first()
    assert abs(noise["mean"] - np.euler_gamma) < 0.03 and abs(noise["var"] - np.pi ** 2 / 6) < 0.06
    docs = spark.createDataFrame([(i, "x y" if i % 3 else "z") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 60, 7)], "doc_id long, quality int")
    for k in (0, 1, 25, 59, 60, 99):
        rows = q.resample(docs, labels, k=k).withColumn("noise", q.gumbel("doc_id")).collect()
        best = sorted(rows, key=lambda r: -(r.log_weight + r.noise))[:k]
        assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in best}
    assert any(r.kept for r in rows if r.log_weight < max(x.log_weight for x in rows))


def test_quality_defined_cases(spark):
    docs = spark.createDataFrame([(1, "x y z", "s"), (None, None, "s"), (1, "x y z", "s")], "doc_id long, text string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in q.resample(docs, none).collect()] == [True, True, True]
    assert q.resample(docs.limit(0), none).count() == 0


def test_best_bar_parts_classes():
    mean = np.array([0.1, 0.2, 0.9, 1.0])
    assert 0.2 < q.best_bar(mean, np.array([False, False, True, True])) < 0.9
    assert q.best_bar(mean, np.array([True] * 4)) == 0.0


def test_toxicity_finds_labelled_and_leaves_clean(spark):
    from tabmill.llm.queries import op8_toxicity

    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = op8_toxicity(spark, "/root/testdata/sf0.1").collect()
    caught = [r.toxic for r in rows if labels.get(r.doc_id) == 1]
    clean = [r.toxic for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(caught) > 0.9 and np.mean(clean) < 0.01
    assert all(0 <= r.severity <= 2 for r in rows)


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(4)
    present = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(600)]
    score = np.array([sum((0.0, 0.0, 2.0, 4.0, 0.0, 0.0)[i] for i in p) for p in present])
    grade = (score > 1).astype(int) + (score > 3)
    w, theta = tox.fit_ordinal(present, grade, 6)
    assert w[3] > w[2] > max(abs(w[[0, 1, 4, 5]])) and np.all(np.diff(theta) >= 0)


def test_toxicity_defined_cases(spark):
    docs = spark.createDataFrame([(1, "you idiot", "g"), (2, "fine day", "g"), (3, None, "g"), (4, "", "g"), (None, "IDIOT", "g"), (1, "you idiot", "g")],
                                 "doc_id long, text string, severity string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (9, 1)], "doc_id long, toxic int")
    model = tox.fit(docs, labels)
    got = tox.score(docs, model).collect()
    assert got[0].severity == got[5].severity and got[2].severity == got[3].severity
    none = tox.fit(docs, labels.where("toxic = 0"))
    assert {r.severity for r in tox.score(docs, none).collect()} == {0.0}
    assert tox.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("text,expected", [("ab", 0), ("abcdefg", 4)])
def test_stems_only_of_longer_words(text, expected):
    data = np.frombuffer(text.encode(), np.uint8)
    h, _ = tox._marks(tv.Words(data, np.array([0, len(data)])))
    assert len(h) == 1 + expected


UNLEARNED = {
    "it": "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Ah quanto a dir qual era",
    "pl": "Litwo! Ojczyzno moja! ty jesteś jak zdrowie; Ile cię trzeba cenić, ten tylko się dowie, Kto cię stracił. Dziś piękność twą",
    "nl": "Een volk dat voor tirannen zwicht, zal meer dan lijf en goed verliezen, dan dooft het licht. Ik ben makelaar in koffie",
    "ja": "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。",
    "ru": "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Все смешалось в доме Облонских",
}


def test_languages_never_learned_are_told_and_short_texts_kept(spark):
    import pyarrow as pa

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    drawn = li.training_sample(docs.where(~li.held_out(docs.doc_id)), rows=li.ROWS + li.LIMIT_ROWS)
    model = li.build_model({k: v[:li.ROWS] for k, v in drawn.items()})
    limits = li.known_limits(model, {k: v[li.ROWS:] for k, v in drawn.items()})
    assert not li.predict_columns(model, pa.array(list(UNLEARNED.values())), limits)[2].any()
    texts = [r.text for r in docs.where(li.held_out(docs.doc_id) & docs.lang.isNotNull() & docs.text.isNotNull()).collect() if any(map(str.isalpha, r.text))]
    assert li.predict_columns(model, pa.array(texts), limits)[2].mean() > 0.99
    for n in (1, 2, 3):
        short = [t for t in (" ".join(x.split()[:n]) for x in texts) if any(map(str.isalpha, t))]
        assert li.predict_columns(model, pa.array(short), limits)[2].mean() > 0.99
    assert li.known_limits(None, {}) is None
    assert li.predict_columns(model, pa.array(["", None, "12"]), limits)[2].tolist() == [False] * 3
