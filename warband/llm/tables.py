"""Reading the given tables and naming tokenizer files, for the queries and the pipeline."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TOKENIZER_DIR = "WARBAND_TOKENIZER_DIR"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Path of a tokenizer file, the same on driver and executors: in the folder of ``WARBAND_TOKENIZER_DIR``,
    else where the installed package of public tokenizers has it."""
    if folder := os.environ.get(TOKENIZER_DIR):
        return os.path.join(folder, name)
    import public_tokenizers
    return str(public_tokenizers.path(name))
