"""Reading tables and cutting lineage, shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of one Arrow batch; texts can be long, so a Python worker never holds many of them.
ARROW_ROWS = 1000


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; all of them may be set at run time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One parquet table of ``sf_dir``, pruned to ``columns`` when some are named."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    In local mode a temporary folder stands in where it is unset; on a cluster that raises, as executors would each write
    to a disk of their own.
    """
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + os.path.join(tempfile.gettempdir(), "siltstone-checkpoints")
    return at.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application below the shared one."""
    return f"{shared_dir(spark)}/siltstone/{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> bool:
    """Deletes the tables that ``cut`` has written in this application; results that read them are void then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and read it back.

    The lineage ends there, so a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
