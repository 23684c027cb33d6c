"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline as pipeline
from tarmac.llm import common, decontam, mixing, pii, simhash

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    names, kept = docs.columns, docs
    counts = []
    for name, stage in pipeline.STAGES[:-1]:
        kept = common.materialise(stage(spark, kept, SF))
        assert kept.columns == names, name
        counts.append(kept.count())
        if name == "near_duplicates":
            again = simhash.near_duplicates(kept).where("doc_id <> component_id").count()
            assert again == 0
        if name == "decontamination":
            assert decontam.contaminated(kept, common.table(spark, SF, "benchmark")).count() == 0
        if name == "personal_data":
            assert all(not pii.base_spans(r.text or "") and r.n_chars == len(r.text) for r in kept.collect())
    assert docs.count() > counts[0] > counts[1] > counts[2] == counts[3] > 0.5 * docs.count()
    want = sorted(map(tuple, mixing.taken(kept).collect()))
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == want


def test_clean_documents_stay(spark):
    labels = {r.doc_id: r.quality for r in common.table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in pipeline.keep_quality(spark, common.table(spark, SF, "documents"), SF).select("doc_id").collect()}
    good = [i for i, y in labels.items() if y == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
