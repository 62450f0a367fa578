"""Session factory, table access and the folder for checkpoints and written intermediates."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_staged: list[tuple[SparkSession, str]] = []


def get_spark(app: str = "foliospark", master: str = "local[8]", partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` where the cluster names one, else the context's own.

    Only a session on this machine alone, as in tests, gets a temporary folder where neither is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    own = sc._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="foliospark-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with its lineage cut, in the shared folder, so a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    The files go once the session ends, or at once by ``drop_staged``.
    """
    path = f"{shared_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    _staged.append((df.sparkSession, path))
    if len(_staged) == 1:
        atexit.register(drop_staged)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def drop_staged() -> None:
    """Delete what ``stage`` has written; results read from it must have been written or collected before."""
    while _staged:
        spark, path = _staged.pop()
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, path)
        except Exception:  # noqa: BLE001 - a session that has ended can delete nothing more
            return
