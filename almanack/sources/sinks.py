"""Writing tables, and the shared folder for work in progress."""

import uuid

from pyspark.sql import functions as F


def shared_folder(spark):
    """The folder the cluster names in ``spark.checkpoint.dir``, else one in the
    warehouse, which all executors share as well."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"


def staging_path(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def owned_by_session(spark, path):
    """Let the session's file system remove ``path`` when the session's JVM ends."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)


def removed(spark, path):
    """Remove a staged table that no later step reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def staged(df, name, path=None):
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage before repeated use; unlike cached blocks the copy outlives
    an executor.  It lasts as long as the session.
    """
    spark = df.sparkSession
    path = path or staging_path(spark, name)
    df.write.parquet(path)
    owned_by_session(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def write_csv(df, path, mode="overwrite"):
    df.write.mode(mode).option("header", True).csv(path)


def write_series_table(df, path, key="series", mode="overwrite"):
    """Partitioned by series, so a reader of one series opens only its files.

    Rows are first spread by series and month: a large series is written by many
    tasks and a small one does not leave a file per task.
    """
    spread = [F.col(key)] + ([F.trunc("date", "month")] if "date" in df.columns else [])
    df.repartition(*spread).write.mode(mode).partitionBy(key).parquet(path)


def write_with_parameters(df, series, parameters, path):
    """A table with its run parameters beside it: one row per series to model, with the
    dates and whatever else the run was made with."""
    df.write.parquet(f"{path}/data")
    named = series.select("series", *[F.lit(v).alias(k) for k, v in parameters.items()])
    named.write.parquet(f"{path}/parameters")


def read_with_parameters(spark, path):
    return spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/parameters")
