"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerflow-"))
    return spark.sparkContext.getCheckpointDir()


class Staging:
    """Writes frames as parquet under one fresh folder and hands back the stored tables.

    A stored table cuts the lineage: later plans scan it with column pruning and filter
    push-down, and a lost executor costs no recomputation of what went into it."""

    def __init__(self, spark: SparkSession, compression: str | None = None):
        self.spark, self.compression = spark, compression
        self.folder = f"{shared_folder(spark)}/ledgerflow-{uuid.uuid4().hex}"

    def remove(self) -> None:
        """Deletes the folder; frames that read from it are of no use afterwards."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        frame.write.mode("overwrite").parquet(path, compression=self.compression)
        return self.spark.read.schema(frame.schema).parquet(path)
