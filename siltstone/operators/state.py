"""Processing state, statistics and usage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_state(state: DataFrame) -> DataFrame:
    """``path, success, ts, error``: the last attempt of each path; of equal times a success, then the greater error."""
    last = state.groupBy("path").agg(F.max(F.struct("ts", F.coalesce("success", F.lit(False)).alias("success"), F.coalesce("error", F.lit("")).alias("error"))).alias("s"))
    return last.select("path", "s.success", "s.ts", "s.error")


def unprocessed(files: DataFrame, state: DataFrame, column: str = "source") -> DataFrame:
    """Files whose path has no successful last attempt."""
    done = latest_state(state).where("success").select(F.col("path").alias(column))
    return files.join(done, column, "left_anti")


def processing_stats(files: DataFrame, state: DataFrame) -> DataFrame:
    """``format, total, successful, failed``: one row a format of the files seen, by their last attempt."""
    last = latest_state(state).select(F.col("path").alias("source"), "success")
    one = files.groupBy("source").agg(F.min(F.lower("format")).alias("format"))
    return one.join(last, "source", "left").groupBy("format").agg(F.count("*").alias("total"), F.count_if(F.coalesce("success", F.lit(False))).alias("successful"), F.count_if(F.col("success").isNotNull() & ~F.col("success")).alias("failed"))


def usage_summary(usage: DataFrame) -> DataFrame:
    """``model, task, calls, input_tokens, output_tokens, failed``."""
    return usage.groupBy("model", "task").agg(F.count("*").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.count_if(~F.col("success")).alias("failed"))
