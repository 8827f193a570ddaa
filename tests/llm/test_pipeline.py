import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_rows_of_their_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.saved(stage(spark, seen, SF))
        assert out.columns == docs.columns
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in seen.select("doc_id").collect()}
        if name in ("line dedup", "substring dedup"):
            assert out.count() == seen.count()
        seen = out
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in seen.select("doc_id").collect()}
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, corpus_pipeline.pack(spark, seen, SF).collect()))


def test_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
