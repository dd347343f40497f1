"""Session builder used by tests, the bench and stand-alone runs."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tripmill", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; extra ``conf`` keys use ``__`` for dots.

    On a cluster leave ``master`` unset: master, memory and shuffle settings
    then come from spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def local_session(cores: int | None = None, memory: str = "8g", **conf: str) -> SparkSession:
    cores = cores or min(8, os.cpu_count() or 1)
    settings = {
        "spark__sql__shuffle__partitions": str(cores),
        "spark__driver__memory": memory,
        "spark__ui__enabled": "false",
        **conf,
    }
    return build_session("tripmill-local", f"local[{cores}]", **settings)


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tripmill-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of the machine;
    on a cluster every executor has to see the path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/tripmill-{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage before iterative work; a lost executor re-reads files
    instead of repeating everything upstream.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
