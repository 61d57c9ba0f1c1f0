"""Session settings, table access and lineage cutting shared by all operators."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lexmill").config("spark.ui.enabled", "false")
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", "8")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only where that setting is absent and the session runs on this machine
    alone, as in tests, a temporary folder is made; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not known and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not known:
        known = tempfile.mkdtemp(prefix="lexmill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(known)
    return known


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tokenizer_dir() -> str:
    return os.environ.get("LEXMILL_TOKENIZERS", "/opt/tokenizers")
