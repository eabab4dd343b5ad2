"""Language ID against plain recomputation, a language with hardly any text, and gibberish."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from entiva.llm import language
from entiva.llm.common import fold

SOME = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(SOME).select("doc_id", "text", "lang").cache()


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents, training=fold("doc_id", 4) != 2)


def held_out(documents):
    return documents.filter((fold("doc_id", 4) == 2) & F.col("lang").isNotNull())


def accuracy(documents, model):
    found = language.predict(held_out(documents), model).join(documents, "doc_id")
    return found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]


def test_scores_equal_plain_compression(documents, model):
    import zstandard

    rows = held_out(documents).limit(40)
    texts = {r.doc_id: r.text for r in rows.collect()}
    settings = zstandard.ZstdCompressionParameters.from_level(
        model.level, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    for row in language.predict(rows, model).collect():
        text = language.letters(texts[row.doc_id]).strip()
        text = f" {text} " * 4 if len(text) < 100 else text
        blocks = [text[i : i + model.block_chars] for i in range(0, len(text), model.block_chars)]
        sizes = {}
        for lang, parts in model.dictionaries.items():
            total = 0
            for part in parts:
                data = zstandard.ZstdCompressionDict(
                    part, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                data.precompute_compress(level=model.level)
                packer = zstandard.ZstdCompressor(dict_data=data, compression_params=settings)
                total += sum(len(packer.compress(block.encode())) for block in blocks)
            sizes[lang] = total / len(parts)
        best, second = sorted(sizes.values())[:2]
        assert sizes[row.lang_pred] == best
        assert row.margin == pytest.approx((second - best) / second)
        assert row.rejected == (row.margin < 0.01)


def test_a_stray_label_costs_no_accuracy(spark, documents, model):
    stray = spark.createDataFrame([(-1, "xyzzy", "zz")], documents.schema)
    with_stray = language.fit(documents.unionByName(stray), training=fold("doc_id", 4) != 2)
    own = {lang: parts for lang, parts in with_stray.dictionaries.items() if lang != "zz"}
    assert own == model.dictionaries
    assert accuracy(documents, with_stray) >= accuracy(documents, model) - 0.004


def test_gibberish_is_mostly_rejected_and_text_is_not(spark, documents, model):
    draw = random.Random(1)
    rows = []
    for i in range(150):
        words = draw.choice((5, 20, 100))
        rows.append((i, " ".join(
            "".join(draw.choices("bcdfghjklmnpqrstvwxz", k=draw.randrange(3, 9)))
            for _ in range(words)
        )))
    gibberish = spark.createDataFrame(rows, "doc_id long, text string")
    assert language.predict(gibberish, model).filter("rejected").count() >= 110
    real = language.predict(held_out(documents), model)
    assert real.filter("rejected").count() <= 0.02 * real.count()
