"""Tables written between two parts of a job, in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return folder.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 8 MB where the session has Spark's default of 64 MB: texts are large, and an executor
    holds several copies of a batch on their way to Python and back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, "8388608b")


class Scratch:
    """Parquet tables under the shared folder. They outlive lost executors and go when the process ends,
    or earlier with ``drop``."""

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
        self.tables = 0
        atexit.register(self.drop)

    def store(self, df: DataFrame) -> DataFrame:
        """``df`` written once and read back, so that its plan and its randomness end here."""
        self.tables += 1
        path = f"{self.folder}/{self.tables}"
        df.write.option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back.scratch_path = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Deletes these tables, or all of them."""
        if self.spark.sparkContext._jsc is None or self.spark.sparkContext._jsc.sc().isStopped():
            return
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in [t.scratch_path for t in tables] or [self.folder]:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
