"""Tables worked off in checkpointed micro-batches: what was done is not done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions import urls
from ledgerloom.session import Kept
from ledgerloom.sources.tables import table


def work_off(spark: SparkSession, source: str, schema, make: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, files: int = 8) -> int:
    """Reads the Parquet files below ``source`` that the checkpoint doesn't know, ``files`` at a time, and appends ``make`` of them to ``target``.

    A batch is written to a folder of its own, so one that is run again after a failure replaces itself. Returns the rows read.
    """
    read = 0

    def one(batch: DataFrame, number: int) -> None:
        make(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    for step in query.recentProgress:
        read += step.numInputRows
    return read


def drain(phases: list[Callable[[], int]], rounds: int = 100) -> int:
    """Runs phases one after the other, each of which returns how much it did, until a round does nothing; the sum. More rounds than allowed are an error."""
    done = 0
    for _ in range(rounds):
        now = sum(phase() for phase in phases)
        if not now:
            return done
        done += now
    raise RuntimeError(f"work was left after {rounds} rounds")


def domains_in_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The hosts of companies, taken from files as a stream would bring them."""
    kept = Kept(spark)
    companies = table(spark, folder, "companies").select("id", "website")
    companies.repartition(4, "id").write.parquet(f"{kept.root}/in")
    work_off(spark, f"{kept.root}/in", companies.schema, lambda b: b.select("id", urls.domain(b.website).alias("domain")), f"{kept.root}/out", f"{kept.root}/progress", files=2)
    return spark.read.parquet(f"{kept.root}/out").select("id", "domain")
