"""The folder that all executors share, and cutting the lineage of iterative plans in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _checkpoints(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from spark.checkpoint.dir; only on a local master that names none a temporary one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        where = sc.getConf().get("spark.checkpoint.dir", None)
        if where is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="spliceloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the session's checkpoint folder."""
    path = f"{_checkpoints(spark)}/{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the session's checkpoint folder, without its lineage."""
    _checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def let_go(df: DataFrame) -> None:
    """Deletes the files of a table that ``cut`` returned and that nothing reads any more."""
    plan = df._jdf.queryExecution().logical()
    if not plan.getClass().getName().endswith("LogicalRDD"):
        return
    at = plan.rdd().getCheckpointFile()
    if at.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at.get())
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
