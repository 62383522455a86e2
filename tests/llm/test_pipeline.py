import cases
import pytest
import test_decontamination
import test_jaccard_join
import test_line_frequency

import corpus_pipeline
from tidewatch.llm.language import language_filter


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("corpus"))
    rows, items = test_decontamination.planted()
    rows += [(1000 + k, t) for k, t in enumerate(cases.texts(60))]
    rows += [(2000 + k, t) for k, t in test_jaccard_join.varied(60)]
    cases.documents(spark, rows).drop("start", "length").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_stages_against_brute_force(spark, folder, vocabulary):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    names = docs.columns
    kept, texts = docs, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = kept.collect()
        kept = stage(spark, kept, folder)
        assert kept.columns == names
        found = kept.collect()
        kept = spark.createDataFrame(found, docs.schema)
        texts = sorted((r.doc_id or -1, r.text or "") for r in found)
        if name == "quality rules":
            limits = test_line_frequency.LIMITS | {"max_docs": 50, "least_share": 0.2}
            old = dict(test_line_frequency.LIMITS)
            test_line_frequency.LIMITS.update(limits)
            verdicts = test_line_frequency.brute(rows)
            test_line_frequency.LIMITS.update(old)
            wanted = [(r.doc_id or -1, r.text or "") for r, v in zip(rows, verdicts, strict=True) if v[-1]]
            assert texts == sorted(wanted)
        elif name == "n-gram Jaccard join":
            _, groups, sets = test_jaccard_join.brute(rows, 5, 80)
            assert len(texts) == sum(len(m) if not sets[m[0]] else 1 for m in groups.values())
        elif name == "benchmark decontamination":
            hit = test_decontamination.brute([(k, r.text) for k, r in enumerate(rows)], benchmark, 0.2)
            bad = {h[0] for h in hit}
            wanted = [(r.doc_id or -1, r.text or "") for k, r in enumerate(rows) if k not in bad]
            assert texts == sorted(wanted) and bad
        else:
            assert len(texts) > 0.5 * len(rows)
    packed = corpus_pipeline.packing(spark, kept, folder).collect()
    assert {r.doc_id or -1 for r in packed} == {t[0] for t in texts}


def test_run_is_the_stages_in_turn(spark, folder, vocabulary):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_empty_table(spark, vocabulary):
    docs = cases.empty(spark).drop("start", "length")
    assert language_filter(docs).count() == 0
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 0


def test_clashing_columns(spark):
    docs = cases.documents(spark).drop("start", "length")
    more = docs.selectExpr("*", "1 as k_id", "'x' as k_key", "2 as root", "3 as cls", "4 as equal")
    assert corpus_pipeline.near_duplicates(spark, more, "").columns == more.columns
    assert corpus_pipeline.near_duplicates(spark, more, "").count() == corpus_pipeline.near_duplicates(spark, docs, "").count()
