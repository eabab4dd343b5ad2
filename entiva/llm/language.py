"""Language identification by compression.

Each language has raw-content dictionaries for zstandard, made of sample texts. A text is
cut into blocks, and each block is compressed with the dictionaries of every language; the
language with the fewest bytes in all is chosen. Blocks are compressed one by one, so that a
long text cannot serve as its own dictionary and every part of it counts alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiva.llm.common import ship, text_or_empty

UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Dictionaries by language, of one size but for languages with little text."""

    dictionaries: dict[str, list[bytes]] = field(default_factory=dict)
    level: int = 5
    block_chars: int = 2_000


def fit(
    documents: DataFrame,
    training: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    sample_documents: int = 600,
    sample_chars: int = 2_000,
    dictionary_bytes: int = 64_000,
    dictionaries: int = 3,
    enough: float = 0.25,
    most_languages: int = 200,
) -> LanguageModel:
    """Learn from rows that meet ``training`` and have a language and a letter.

    The sample is bounded: per language the ``sample_documents`` rows of lowest id hash, of
    each at most ``sample_chars`` characters. Languages get dictionaries of one size, so that
    none wins by having more: that of the language with the least text of those with at least
    ``enough`` of the most. A language with less than that has smaller ones, of all its text, and
    costs the others nothing. More than ``most_languages`` languages are an error. Without any training row the model is empty.
    """
    rows = documents.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.col(lang_column).cast("string").alias("lang"),
        training.alias("training"),
    ).filter("training and lang is not null and text is not null")
    rows = rows.filter(F.col("text").rlike(r"\p{L}")).select(
        "lang",
        F.xxhash64(F.col("id"), F.length("text")).alias("draw"),
        F.substring("text", 1, sample_chars).alias("text"),
    )
    # drawn without the texts, and with the limit pushed below the exchange, so that a task
    # sends a few numbers; then the texts of those drawn
    by_draw = Window.partitionBy("lang").orderBy("draw")
    drawn = (
        rows.select("lang", "draw")
        .withColumn("n", F.row_number().over(by_draw))
        .filter(F.col("n") <= sample_documents)
        .groupBy("lang", "draw")
        .agg(F.min("n").alias("n"))
    )
    chosen = (
        rows.join(F.broadcast(drawn), ["lang", "draw"])  # sample_documents per language
        .groupBy("lang", "n")
        .agg(F.min("text").alias("text"))
    )
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in chosen.collect():  # sample_documents x sample_chars per language at most
        texts.setdefault(row.lang, []).append((row.n, row.text))
    if len(texts) > most_languages:
        raise ValueError(f"{len(texts)} languages, more than most_languages={most_languages}")
    model = LanguageModel()
    if not texts:
        return model
    joined = {}
    for lang, own in texts.items():
        whole = [letters(t).encode() for _, t in sorted(own)]
        joined[lang] = [b"\n".join(whole[i::dictionaries]) for i in range(dictionaries)]
    most = [max(len(b) for b in parts) for parts in joined.values()]
    size = min(dictionary_bytes, *(m for m in most if m >= enough * max(most)))
    size = max(size, 256)
    for lang, parts in sorted(joined.items()):
        model.dictionaries[lang] = [p[-size:] for p in parts if p] or [b" "]
    return model


_no_letters = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case words of letters; case, marks and layout say nothing about the language."""
    return _no_letters.sub(" ", text.lower())


class Compressors:
    """A model made ready in one Python worker."""

    def __init__(self, model: LanguageModel):
        import zstandard

        self.model = model
        self.languages = list(model.dictionaries)
        parameters = zstandard.ZstdCompressionParameters.from_level(
            model.level, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        self.compress = []
        for parts in model.dictionaries.values():
            own = []
            for part in parts:
                data = zstandard.ZstdCompressionDict(
                    part, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                data.precompute_compress(level=model.level)
                own.append(
                    zstandard.ZstdCompressor(
                        dict_data=data, compression_params=parameters
                    ).compress
                )
            self.compress.append(own)

    def sizes(self, text: str) -> np.ndarray:
        """Bytes per language, the mean of its dictionaries."""
        step = self.model.block_chars
        text = letters(text).strip()
        if len(text) < 100:
            # so short a text is stored as it is; its repetition is not, and shows its matches
            text = f" {text} " * 4
        blocks = [text[i : i + step].encode() for i in range(0, len(text), step)]
        found = []
        for own in self.compress:
            found.append(sum([len(c(b)) for c in own for b in blocks]) / len(own))
        return np.array(found)


def predict(
    documents: DataFrame,
    model: LanguageModel,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_margin: float = 0.01,
) -> DataFrame:
    """``doc_id, lang_pred, score, margin, rejected`` of every row; nothing is shuffled.

    The whole text counts. ``margin`` is the lead of the best language over the second as a
    share of the second's bytes, and ``score`` its share of the evidence (0 to 1). Rejected
    are texts whose margin is below ``least_margin`` and texts that are null or have no letter;
    the latter get ``und``, score 0 and margin 0, and so does every text if the model is empty.
    A model of one language accepts all texts with a letter. Ties go to the language first
    in the alphabet. Repeated rows get the same answer; other columns are ignored.
    """
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(
        F.col(id_column).alias("doc_id"),
        F.when(F.col(text_column).rlike(r"\p{L}"), text_or_empty(text_column)).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Compressors(sent.value)
        for batch in batches:
            answers = [answer(ready, t, least_margin) for t in batch.column(1).to_pylist()]
            langs, scores, margins, rejected = zip(*answers, strict=True) if answers else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(margins, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    return rows.mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, margin double, rejected boolean"
    )


def answer(
    ready: Compressors, text: str | None, least_margin: float
) -> tuple[str, float, float, bool]:
    if not text or not ready.languages:
        return UNKNOWN, 0.0, 0.0, True
    sizes = ready.sizes(text)
    best = int(sizes.argmin())
    if len(sizes) == 1:
        return ready.languages[best], 1.0, 1.0, False
    second = float(np.delete(sizes, best).min())
    margin = (second - float(sizes[best])) / second
    score = 1 / float(np.exp2(-np.minimum(4 * (sizes - sizes[best]), 500)).sum())
    return ready.languages[best], score, margin, margin < least_margin
