"""Session helpers: tables, lineage cuts and sizes that decide on a broadcast."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine expects; a session made elsewhere keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "4g", **conf: str) -> SparkSession:
    """A local session with the engine's settings, as tests and bench.py use it."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("brindle").config("spark.driver.memory", memory).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, prefix: str) -> str:
    """A folder all executors see: spark.checkpoint.dir of the session. Only a local master may do without that setting
    and gets a temporary folder; a cluster without it is an error, not a folder on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=prefix)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder all executors share (shared_folder)."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(spark, "brindle-"))
    return df.checkpoint(eager=True)
