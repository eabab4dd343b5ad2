"""Session helpers and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_local_root: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets one temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="entiva-"))
    return _local_root[0]


class Workspace:
    """Intermediate tables of one run, written under the shared scratch folder.

    A written table cuts the lineage of an iterative job and survives lost executors. It
    also gives the optimizer true sizes, so small ones are broadcast and large ones are not.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{scratch_root(spark)}/entiva-{uuid.uuid4().hex}"

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        """Delete the tables of the run; by then its result must be stored elsewhere."""
        delete_path(self.spark, self.path)

    def folder(self, label: str) -> str:
        return f"{self.path}/{label}"

    def keep(self, df: DataFrame, label: str, by: str | None = None) -> DataFrame:
        """Write ``df`` once and return a frame that reads it back.

        ``by`` names a column of few values; readers of one value skip the other folders.
        """
        folder = self.folder(label)
        df.write.mode("overwrite").parquet(folder, partitionBy=by)
        return self.spark.read.schema(df.schema).parquet(folder)

    def rounds(self, label: str) -> DataFrame:
        """All that was kept under ``label/round=0``, ``label/round=1``, ... as one table, so
        that the plan does not grow with the number of rounds."""
        return self.spark.read.parquet(self.folder(label)).drop("round")

    def drop(self, label: str) -> None:
        """Delete a table of this run that no later step reads."""
        delete_path(self.spark, self.folder(label))


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system object and path object for ``path``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def delete_path(spark: SparkSession, path: str) -> None:
    filesystem, target = hadoop_path(spark, path)
    filesystem.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if there is none."""
    filesystem, file = hadoop_path(spark, path)
    if not filesystem.exists(file):
        return None
    stream = filesystem.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside ``path`` and rename it over that, in one step where the file
    system can; readers see the old content or the new."""
    jvm = spark._jvm
    filesystem, beside = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = filesystem.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    _, target = hadoop_path(spark, path)
    overwrite = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        filesystem.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(filesystem.makeQualified(beside), filesystem.makeQualified(target), overwrite)
