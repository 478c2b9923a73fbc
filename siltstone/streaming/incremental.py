"""Incremental ingest: new files are parsed once, state and documents are appended batch by batch.

Each micro-batch writes its documents and then its state under its own number, so a batch that is run again after a
failure replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone import schemas
from siltstone.config import Config
from siltstone.functions.text import suffix
from siltstone.sources.files import parsed
from siltstone.sources.sinks import state_rows

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, config: Config = Config(), files_per_batch: int = 1000) -> StreamingQuery:
    """Starts a query over the files below ``folder`` that ends when all present ones are read (available now)."""
    files = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).load(folder)
    wanted = files.where(suffix(F.col("path")).isin(*config.text_suffixes))

    def write(batch: DataFrame, number: int) -> None:
        docs = parsed(batch).withColumn("batch", F.lit(number)).persist()
        docs.where("error is null").drop("error").write.mode("overwrite").parquet(f"{out}/documents/batch={number}")
        state_rows(docs).write.mode("overwrite").parquet(f"{out}/state/batch={number}")
        docs.unpersist()

    return wanted.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def latest_per_path(spark: SparkSession, folder: str, late: str = "1 day") -> DataFrame:
    """A stream of state rows (Parquet) without repeats of one path and time that are at most ``late`` apart."""
    stream = spark.readStream.schema(schemas.STATE).parquet(folder)
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["path", "ts"])
