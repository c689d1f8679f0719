"""Each stage against its own rule, and the whole run."""

import corpus_pipeline as c
from tests.conftest import SF_MID
from tests.llm.test_ngram_jaccard import brute


def test_stages_one_by_one(spark):
    docs = c.table(spark, SF_MID, "documents")
    good = c.written(c.keep_quality(spark, docs, SF_MID), "t")
    assert good.columns == docs.columns and 0.8 * docs.count() < good.count() < docs.count()
    named = c.written(c.keep_language(spark, good, SF_MID), "t")
    assert named.columns == docs.columns and named.count() > 0.99 * good.count()

    few = named.limit(250)
    rows = [(r.doc_id, r.text) for r in few.collect()]
    want = sorted({comp for _, _, comp in brute(rows, 5, 80, 100)})
    kept = c.drop_near_duplicates(spark, c.written(few, "t"), SF_MID)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want

    clean = c.drop_benchmark(spark, named, SF_MID)
    assert clean.columns == docs.columns
    found = {r.doc_id for r in c.decontaminate.contaminated(named, c.table(spark, SF_MID, "benchmark")).collect()}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in named.collect() if r.doc_id not in found)

    last = c.encode_pieces(spark, clean.limit(50), SF_MID).collect()
    assert len(last) == 50 and all(r.lossless for r in last)


def test_defined_cases(spark):
    rows = [(1, "the red fox ran over the green hill and far away", "en", "s", 1), (2, None, "en", "s", 0), (None, "", None, None, None),
            (1, "the red fox ran over the green hill and far away", "en", "s", 1), (3, "12 34", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in c.keep_quality(spark, docs, SF_MID).collect()} >= {1, 2, None}
    assert [r.doc_id for r in c.keep_language(spark, docs, SF_MID).collect()] == [1, 1]
    assert c.drop_near_duplicates(spark, docs, SF_MID).count() == 5
    assert c.drop_benchmark(spark, docs, SF_MID).count() == 5
    for _, stage in c.STAGES:
        assert stage(spark, docs.limit(0), SF_MID).count() == 0


def test_run_and_registration(spark):
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [n for n, _ in c.STAGES] == ["quality", "language", "near_duplicates", "benchmark", "pieces"]
    out = c.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "lang", "n_pieces", "ids", "lossless"] and out.count() > 0
