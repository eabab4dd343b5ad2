"""Stages over rows whose ids are repeated or missing."""

import corpus_pipeline


def test_stages_tell_rows_of_one_id_apart(spark):
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text
    long_text = " ".join(f"word{i} of row{i % 7}" for i in range(80))
    rows = [
        (1, "a first text"), (1, "a first text"), (2, "a first text"), (2, "a text of its own"),
        (None, "a first text"), (None, "another text"), (None, "another text"),
        (3, long_text), (4, long_text + " end"), (3, "quite another matter, all of it"),
        (5, item), (5, "nothing of the benchmark in this"), (None, "Here: " + item),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)

    def stay(name, docs):
        return sorted(map(tuple, stages[name](spark, docs, "/root/testdata/sf0.001").collect()), key=str)

    exact = [rows[i] for i in (0, 3, 5, 7, 8, 9, 10, 11, 12)]
    assert stay("exact_dedup", frame) == sorted(exact, key=str)
    near = stay("near_dedup", spark.createDataFrame([rows[i] for i in (3, 7, 8, 9)], frame.schema))
    assert len(near) == 3 and rows[3] in near and rows[9] in near
    assert stay("decontamination", spark.createDataFrame(rows[10:], frame.schema)) == [rows[11]]


def test_stages_keep_a_column_with_the_name_of_the_key(spark):
    rows = [(1, "one text here", "a"), (2, "one text here", "b"), (3, "another text", "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, pipeline_row_key string")
    kept = corpus_pipeline.drop_exact_copies(spark, frame, "/root/testdata/sf0.001")
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
