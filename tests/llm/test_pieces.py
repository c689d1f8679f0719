import numpy as np
import pytest
import sentencepiece

from tabmill.llm import pieces as p
from tests.conftest import SF_SMALL

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ODD = ["", " ", "  a  b ", "x\n\ny", "▁a▁ b", "日本語 テスト", "😀 <s> <0x0A>", "a" * 300, "\t\r\n", "é" * 70, "Ab"]


@pytest.fixture(scope="module")
def vocabulary():
    return p.load_vocabulary(MODEL)


def texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + ODD


def split(ids, count):
    return [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]


def test_plain_segmentation_is_the_librarys(spark, vocabulary):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    t = [x for x in texts(spark) if p.MARK not in x]
    coder = p.Coder(vocabulary, 0.0, 1)
    assert split(*coder.encode(t, [0] * len(t))) == [sp.encode(x) for x in t]


def test_dropout_varies_and_decodes(spark, vocabulary):
    t = texts(spark)
    seen = []
    for seed in (1, 2):
        coder = p.Coder(vocabulary, 0.3, seed)
        ids, count = coder.encode(t, p.variant_of(t, coder.variants))
        data, size = coder.decode(ids, count)
        at = np.concatenate(([0], np.cumsum(size)))
        assert [data[a:b].decode() for a, b in zip(at, at[1:])] == t
        seen.append(split(ids, count))
    assert seen[0] != seen[1]
    coder = p.Coder(vocabulary, 0.3, 1)
    assert split(*coder.encode(t, p.variant_of(t, coder.variants))) == seen[0]


def test_merging_in_step_equals_the_heap(vocabulary):
    coder = p.Coder(vocabulary, 0.25, 9)
    for word in (" internationalization", "ouverture", " thheoutionblea", " the", "ab", " ééa"):
        for variant in range(4):
            s = coder.symbols([word])
            ids, n = coder.merge_short(s[None, :], np.array([variant], np.uint64))
            assert coder.merge_long(s, variant).tolist() == ids[0, :n[0]].tolist()


def test_frames_and_defined_cases(spark, vocabulary):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, "x"), (0, ODD[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = p.decode(p.encode(df, vocabulary, lossless_col="lossless"), vocabulary).collect()
    assert [r.decoded for r in got] == [r[1] for r in rows]
    assert all(r.lossless for r in got) and got[len(ODD)].ids is None and got[0].ids == []
    assert p.encode(df.limit(0), vocabulary).count() == 0


def test_query_is_lossless(spark):
    from tabmill.llm.queries import op5_sentencepiece

    rows = op5_sentencepiece(spark, SF_SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in rows)


def test_every_occurrence_and_text_has_its_own_draws(vocabulary):
    word = " internationalization"
    coder = p.Coder(vocabulary, 0.3, 5)
    cuts = lambda t: coder.encode([t], p.variant_of([t], coder.variants))[0]
    head = lambda ids: tuple(ids[np.cumsum(coder.length[ids]) <= len(word)])
    assert len({head(cuts(f"{word[1:]} {i}")) for i in range(100)}) > 8  # one place, many texts
    text = word[1:] + word * 299
    one, s, seen = cuts(text).tolist(), coder.symbols([word]), set()
    for nth in range(300):
        at = p.tv.mix(np.array([(p.variant_of([text], coder.variants)[0] + nth * p.tv._SALTS[0]) % (1 << 64)], np.uint64))
        want = coder.merge_long(s, int(at[0])).tolist()
        assert one[:len(want)] == want
        seen.add(tuple(want))
        one = one[len(want):]
    assert one == [] and len(seen) > 8


def test_what_is_kept_never_changes_a_segmentation(spark, vocabulary, monkeypatch):
    t = texts(spark) + ["x" * 60 + " a", "x" * 60 + " a"]
    coder = p.Coder(vocabulary, 0.2, 3)
    keys = p.variant_of(t, coder.variants)
    want = split(*coder.encode(t, keys))
    assert split(*coder.encode(t, keys)) == want and want[-1] == want[-2]
    monkeypatch.setattr(p, "CACHE", 0)
    coder = p.Coder(vocabulary, 0.2, 3)
    assert [split(*coder.encode([x], [k]))[0] for x, k in zip(t, keys)] == want


def test_rate_of_skips(vocabulary):
    coder = p.Coder(vocabulary, 0.1, 1)
    gaps = coder.gap(np.arange(100_000, dtype=np.uint64), 0)
    assert abs((gaps == 0).mean() - 0.1) < 0.005 and abs((gaps < 6).mean() - (1 - 0.9**6)) < 0.01
    assert (p.Coder(vocabulary, 1.0, 1).gap(np.arange(9, dtype=np.uint64), 0) == 0).all()
