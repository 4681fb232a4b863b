"""Session helpers: building a session, reading tables, cutting lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str = "local[*]", partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; conf entries use dots written as double underscores."""
    b = SparkSession.builder.master(master).appName("hakari").config(map=DEFAULTS)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` in `folder`."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all executors share: the session's spark.checkpoint.dir. Only in local mode,
    and only where that is unset (tests, local runs), a folder of this machine is set."""
    sc = spark.sparkContext
    at = sc._jsc.sc().getCheckpointDir()
    if at.isDefined():
        return at.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "hakari-checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, forget: bool = False) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there.

    A checkpoint keeps the size that the optimizer guessed. In a loop of joins the guess is squared each round, until
    its digits fill the memory; with `forget` the result has no guess (and no known partitioning either).

    The folder is that of shared_folder(). The files are replicated by the shared store, so lost executors cost nothing;
    they are removed with the tables that read them where spark.cleaner.referenceTracking.cleanCheckpoints is set, as
    build() does.
    """
    shared_folder(df.sparkSession)
    done = df.checkpoint(eager=True)
    if not forget:
        return done
    spark = df.sparkSession
    jdf = done._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(jdf.queryExecution().toRdd(), jdf.schema(), False), spark)
