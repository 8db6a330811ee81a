import pytest

from ledgerline.llm import decontamination, mixing, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_dir):
    P = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    cols, seen = docs.columns, []
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_dir}/{k}")
        after = spark.read.parquet(f"{tmp_dir}/{k}")
        ids = sorted(r.doc_id for r in after.select("doc_id").collect())
        if name == "toxicity":
            want = toxicity.op10(docs, labels).where("predicted = 0")
        elif name == "simhash_near_dedup":
            want = simhash.op4(docs).where("doc_id = component_id")
        elif name == "benchmark_decontamination":
            bad = {r.doc_id for r in decontamination.op9(docs, bench).collect()}
            want = docs.where(~docs.doc_id.isin(*bad) if bad else "true")
        elif name == "source_mixing":
            want = mixing.mix(docs)[1]
        else:
            want = docs
        assert ids == sorted(r.doc_id for r in want.select("doc_id").collect())
        assert k == len(P.STAGES) - 1 or after.columns == cols
        seen.append(len(ids))
        docs = after
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))
    assert seen[2] <= seen[1] <= seen[0] <= 200 and seen[2] < 200 and seen[3] <= 2 * seen[2]
