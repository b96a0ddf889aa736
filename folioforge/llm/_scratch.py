"""Places for intermediate tables that all executors see, and joins on skewed keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local one only where none is set."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
        if not found:
            found = f"file://{tempfile.mkdtemp(prefix='checkpoints-')}"
            spark.sparkContext.setCheckpointDir(found)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Tables that are written, read again and dropped when the block ends.

    What outlives the block must be checkpointed first (`keep`): Spark removes a
    checkpoint when nothing refers to it any more, and a written table it cannot.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_: object) -> None:
        self._drop(self.root)

    def _drop(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def table(self, df: DataFrame, name: str, *, by: list[str] | None = None) -> DataFrame:
        """Writes the rows once; what is read back has no lineage and no partitioning."""
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if by:
            writer = writer.partitionBy(*by)
        writer.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        self._drop(f"{self.root}/{name}")


def keep(df: DataFrame) -> DataFrame:
    """An eager checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the stored size, for choosing how many parts to make."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def parts_for(df: DataFrame, each: int, least: int = 1) -> int:
    """How many parts of about `each` stored bytes the rows make."""
    size = input_bytes(df)
    return max(least, min(-(-size // each), 1 << 20)) if size < 1 << 60 else max(least, 200)
