"""The shared folder for data that cuts lineage between steps."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else one in the warehouse.

    Both are places that driver and executors share; neither depends on where the session runs.
    """
    folder = spark.conf.get(SETTING, None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shelfmark"


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid4().hex}"
    _made.append(path)
    return path


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: evaluated once, safe to reuse.

    With ``by`` the rows are laid out by that column, so a read of some of its values skips the rest.
    """
    path = fresh_path(df.sparkSession, label)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.select(*df.columns) if by else back


def discard(spark: SparkSession) -> None:
    """Remove what this process has stored so far; call it once its results have been read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)
