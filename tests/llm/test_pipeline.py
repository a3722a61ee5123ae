"""The pipeline on the small tables and on hard rows."""

import corpus_pipeline
from convivio.llm import decontaminate, quality_rules
from convivio.llm.common import table


def test_stages_take_effect(spark, data):
    docs = table(spark, data, "documents")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], data).cache())
    for before, after in zip(seen, seen[1:-1]):
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert 0 < after.count() <= before.count()
    rules = quality_rules.learn_rules(docs, table(spark, data, "labels"))
    assert seen[1].count() == quality_rules.judge(docs, rules).filter("kept").count()
    assert seen[-1].count() == seen[-2].count()
    assert decontaminate.find_items(seen[4], table(spark, data, "benchmark")).count() == 0
    assert corpus_pipeline.run(spark, data).count() == seen[-1].count()
    assert len({(r.mix_slot, r.mix_place) for r in seen[-1].collect()}) == seen[-1].count()
    spark.catalog.clearCache()


def test_hard_rows(spark, data):
    long = " ".join(f"word{n}" for n in range(60))
    rows = [(1, None, "en", None, None, 1), (2, "", None, "src0", 0, 1), (None, long, "en", "x", 5, 1), (3, long, "en", "src0", 5, 1),
            (3, long, "en", "src0", 5, 1), (4, long + " more", "en", "src0", 5, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, mix_slot int")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, data)
            assert out.count() >= 0
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
