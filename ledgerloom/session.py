"""Session settings and tables kept between the stages of a long job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Spark's setting by which an execution removes its shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A session on this machine, for tests and bench; a cluster brings its own."""
    conf = {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": "8"} | SETTINGS
    conf |= {k.replace("_", "."): v for k, v in settings.items()}
    spark = SparkSession.builder.master(f"local[{cores}]").appName("ledgerloom").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` where the cluster
    names one, else one of our own (tests on one machine)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    kept = spark.sparkContext.getCheckpointDir()
    if not kept:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        kept = spark.sparkContext.getCheckpointDir()
    return kept


class Kept:
    """Stages of a job written as Parquet to the shared folder, so that neither
    a long lineage nor a lost executor costs more than one stage.

    tidy: a stage's shuffle files go when it is written, not whenever the driver collects its garbage.
    """

    def __init__(self, spark: SparkSession, tidy: bool = False):
        self.spark, self.root, self.tidy = spark, f"{shared_folder(spark).rstrip('/')}/kept-{uuid.uuid4().hex}", tidy
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        before = self.spark.conf.get(CLEANUP, None)
        if self.tidy:
            self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            if self.tidy:
                self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        for name in names:
            if old := self.paths.pop(name, None):
                at = jvm.org.apache.hadoop.fs.Path(old)
                at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
