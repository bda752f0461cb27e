"""Written tables: intermediate results that several jobs read, and that outlive a lost executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session without one, as in tests, has a temp folder
    instead, which goes when the process ends."""
    global _LOCAL_DIR
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _LOCAL_DIR is None:
        _LOCAL_DIR = tempfile.mkdtemp(prefix="corpuslm-")
        atexit.register(shutil.rmtree, _LOCAL_DIR, ignore_errors=True)
    return _LOCAL_DIR


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/corpuslm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: runs once, cuts the lineage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
