"""spark-submit entry point: documents of a folder to instruction data."""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siltstone.config import Config, build, load_yaml, validate
from siltstone.io import clean_up, tune
from siltstone.models.clients import client, client_of
from siltstone.operations import load_env, log_to, timed
from siltstone.plans.pipeline import run
from siltstone.sources.files import read_documents, read_with_images
from siltstone.sources.sinks import append, state_rows, write_if_any, write_jsonl


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--config", help="YAML file with settings that differ from the defaults")
    p.add_argument("--model", default="template", help="client that answers prompts, or a model of --models")
    p.add_argument("--models", help="YAML file with a models section; it is checked first")
    p.add_argument("--url", help="address of a served model")
    p.add_argument("--env", help="file with environment variables")
    p.add_argument("--log", default="INFO", help="level of the log")
    p.add_argument("--images", action="store_true", help="also take what pictures in the files show, and image files")
    p.add_argument("--first", type=int, help="read only so many files, by path")
    p.add_argument("--again", action="store_true", help="also read files that are done")
    a = p.parse_args(arguments)
    log_to(a.log)
    load_env(a.env)
    spark = tune(SparkSession.builder.appName("siltstone").getOrCreate())
    config = build(Config, load_yaml(a.config)) if a.config else Config()
    state = None
    if not a.again:
        try:
            state = spark.read.parquet(f"{a.output}/state")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # only the first run has no state; any other fault must not start all over again
    if a.models:
        models = load_yaml(a.models)
        if wrong := validate(models, "models"):
            raise SystemExit("; ".join(wrong))
        model = client_of(models.get("models", models), None if a.model == "template" else a.model)
    else:
        model = client(a.model, **({"url": a.url} if a.url else {}))
    read = read_with_images(spark, a.input, config=config) if a.images else read_documents(spark, a.input, state, config, a.first)
    docs = read.withColumn("doc_id", F.xxhash64("source")).persist()
    with timed("the run"):
        accepted, failed = run(docs.where("error is null"), model, config)
        write_jsonl(accepted, f"{a.output}/instruction_data")
        write_if_any(failed, f"{a.output}/failed_pairs")
        append(state_rows(docs), f"{a.output}/state")
    clean_up(spark)


if __name__ == "__main__":
    main()
