"""The pipeline against its stages worked out one by one in plain Python."""

import re

import corpus_pipeline
from entiva.llm import language
from entiva.llm.common import fold
from tests.llm.test_llm_operators import brute_components

SMALL = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    from tokenizers import Tokenizer

    from entiva.llm.queries import bpe_path

    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit(documents, fold("doc_id", 4) != 2)
    ready = language.Compressors(model)
    rows = []
    for r in documents.collect():
        text = r.text if r.text and re.search(r"[^\W\d_]", r.text) else None
        if not language.answer(ready, text, 0.01)[3]:
            rows.append((r.doc_id, r.text))
    assert len(rows) >= 0.95 * documents.count()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc_id))
    stay = {min(g)[1] for g in groups.values()}
    rows = [r for r in rows if r[0] in stay]
    components = brute_components(rows)
    rows = [r for r in rows if components[r[0]][1] == r[0]]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]

    def words(text):
        return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "

    clean = [r for r in rows if not any(words(i) in words(r[1]) for i in items)]
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(found) <= {r[0] for r in clean}
    assert len(found) >= len(clean) - 2  # passages with an edit may go as well
    library = Tokenizer.from_file(bpe_path())
    for doc_id, text in clean:
        if doc_id in found:
            assert list(found[doc_id].ids) == library.encode(text, add_special_tokens=False).ids


def test_stages_keep_the_columns(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    empty = documents.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SMALL).columns == documents.columns, name
        assert stage(spark, empty, SMALL).count() == 0
