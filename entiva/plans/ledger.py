"""What a layered run has stored, so that a run that was stopped goes on from there.

Each step of a run leaves one small file: the fingerprint of what it was made from. A step
whose fingerprint is still the same is not run again. A step's entry is withdrawn before it
writes and made after it has published, so a step that fails on the way is always run again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiva.session import delete_path, read_text, replace_text

FOLDER = "_runs"


def files_fingerprint(
    spark: SparkSession, paths: Sequence[str], glob: str | None = None, recursive: bool = False
) -> str:
    """Number and digest of the files: path, length and time of change. No content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # two sums of hashes do not depend on the order in which files are listed
    file = [F.col("path"), F.col("length"), F.col("modificationTime")]
    row = reader.load(list(paths)).agg(
        F.count("path"),
        *[F.sum(F.xxhash64(F.lit(seed), *file).cast("decimal(38,0)")) for seed in (1, 2)],
    ).first()
    return ":".join(map(str, row))


def described(value: object) -> str:
    """An option in writing. What cannot be told apart by its writing equals nothing, so a
    step with such an option is never taken for one that has run."""
    if value is None or isinstance(value, (str, int, float, bool)):
        return repr(value)
    if isinstance(value, Mapping):
        return "{" + ",".join(sorted(f"{described(k)}:{described(v)}" for k, v in value.items())) + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(described, value)) + "]"
    name = getattr(value, "__qualname__", "<")
    if isinstance(value, DataFrame) or not callable(value) or "<" in name:
        return uuid.uuid4().hex
    return f"{value.__module__}.{name}"


class Ledger:
    """The steps of one base folder. Without ``resume`` every step runs, and is entered."""

    def __init__(self, spark: SparkSession, base: str, resume: bool):
        self.spark, self.base, self.resume = spark, base.rstrip("/"), resume

    def entry(self, step: str) -> str:
        return f"{self.base}/{FOLDER}/{step}"

    def run(self, step: str, made_from: Sequence[object], action: Callable[[], None]) -> str:
        """Run ``action`` unless the step was stored from the same; returns the fingerprint,
        of which those of later steps are made."""
        text = "\n".join(map(described, made_from))
        fingerprint = hashlib.sha256(text.encode()).hexdigest()
        if self.resume and read_text(self.spark, self.entry(step)) == fingerprint:
            return fingerprint
        delete_path(self.spark, self.entry(step))
        action()
        replace_text(self.spark, self.entry(step), fingerprint)
        return fingerprint
