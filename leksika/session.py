"""Session settings that the engine's results rest on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own for the application only where that is unset and all tasks are on this machine, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="leksika-"))
    return context.getCheckpointDir().get().rstrip("/")


def release(spark: SparkSession) -> None:
    """Delete what this application has ``written``; call it once the results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/leksika-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under one folder for each application."""
    return f"{shared_dir(spark)}/leksika-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: for what is used more than once, so that it is computed once and a lost executor costs nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def session(master: str | None = None, name: str = "leksika", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` adds settings (dots as double underscores)."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    return builder.config(map=settings | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()
