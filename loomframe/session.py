"""Session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "loomframe", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Tables written by this process and not yet released.
_written: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a folder in the warehouse
    is used, which driver and executors share as well.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/loomframe-work"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for a table one job writes and another reads."""
    path = f"{checkpoint_root(spark).rstrip('/')}/work/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` below the checkpoint folder and continue from the files.

    A written table is columnar, tells the optimizer its true size and outlives any executor.
    """
    path = work_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables of this process; call it when results have been consumed.

    Gives the number of tables. Whatever was read from them can't be computed again.
    """
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths, _written[:] = list(_written), []
    for path in paths:
        place = files.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)
