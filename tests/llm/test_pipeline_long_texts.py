"""The stage of benchmark leaks on texts that once ended its executors."""

import corpus_pipeline

ITEM = "Yesterday Anna bought 12 apples for 30 dollars, then Anna gave 5 kg to Bob."


def test_leaks_beside_long_runs_of_names(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    names = "He saw, and " + "Xavier " * 60_000
    rows = [(1, f"{ITEM} {names}"), (1, names), (None, f"{ITEM} {names}"), (2, None), (3, ITEM)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path)).collect()
    assert {(r.doc_id, r.text) for r in left} == {(1, names), (2, None)}
