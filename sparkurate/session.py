"""A session for local runs; on a cluster the caller brings its own."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    session = SparkSession.builder.master(f"local[{cores}]").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the session's shared checkpoint folder; a temporary one where all is local and none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="scratch-")
    return f"{base}/files/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df once written to the scratch folder and read again: what isn't the same in every run, such as where files are split, stays as it was."""
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
