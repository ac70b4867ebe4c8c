"""Time-stamped artefacts: naming them and finding the newest."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

STAMP = "ddMMyyyy_HHmm"


def run_stamp(moment):
    return F.date_format(moment, STAMP)


def latest_run(files, keys=(), name="file", suffix=".pkl"):
    """The newest file per group of keys, by the digits in its name."""
    stamped = files.where(F.col(name).endswith(suffix)).withColumn(
        "_run", F.try_to_timestamp(F.regexp_replace(name, "[^0-9]", ""), F.lit("ddMMyyyyHHmm"))
    )
    return stamped.where("_run IS NOT NULL").groupBy(*keys).agg(
        F.max_by(name, F.struct("_run", name)).alias(name), F.max("_run").alias("run_ts")
    )


def save_best(df, root, stamp):
    """Store a tuning result under its run stamp."""
    df.write.mode("overwrite").parquet(f"{root}/run_ts={stamp}")


def load_latest(spark, root, schema):
    """Rows of the newest stored result; only its partition is read."""
    stored = StructType([*schema.fields, StructField("run_ts", StringType())])
    runs = spark.read.schema(stored).parquet(root)
    stamp = F.try_to_timestamp("run_ts", F.lit(STAMP))
    newest = runs.select("run_ts").distinct().agg(F.max_by("run_ts", stamp)).first()[0]
    return runs.where(F.col("run_ts") == newest)


def model_path(root, series, stamp):
    return f"{root}/series={series}/run_ts={stamp}"


# -- runs that are read only when whole ---------------------------------------

COMMIT = "run_ts string, place string, committed timestamp"


def store_run(spark, root, stamp, write):
    """Let ``write(place)`` fill a new folder, then record the run under its stamp.

    Readers go by the records, so a run that broke off before its record is never
    read; a record is one file and appears whole.
    """
    place = f"{root}/data/{uuid.uuid4().hex}"
    write(place)
    record = spark.range(1).select(F.lit(stamp).alias("run_ts"), F.lit(place).alias("place"), F.current_timestamp().alias("committed"))
    record.coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return place


def stored_runs(spark, root):
    """The records, of which there may be none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/runs")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(COMMIT).parquet(f"{root}/runs") if there else spark.createDataFrame([], COMMIT)


def newest_run(spark, root):
    """The place of the newest run by its stamp, of equals the last recorded; else none."""
    moment = F.try_to_timestamp("run_ts", F.lit(STAMP))
    newest = stored_runs(spark, root).agg(F.max_by("place", F.struct(moment, "committed", "place"))).first()
    return newest[0]


def newest_or_new(spark, root, write, fresh=False):
    """The place of the newest run, or of a new one where there is none or a ``fresh`` one
    is asked for: later stages read what earlier ones stored."""
    place = None if fresh else newest_run(spark, root)
    if place is None:
        stamp = spark.range(1).select(run_stamp(F.current_timestamp())).first()[0]
        place = store_run(spark, root, stamp, write)
    return place


def chosen_parameters(series, default, stored=None, tuned=None):
    """``(series, params, origin)``: for each series what was just ``tuned``, else the best
    of the newest ``stored`` search, else the ``default``, in one plan.

    ``stored`` and ``tuned``: ``(series, params)`` where there are any; a series with
    several rows has the smallest text.
    """
    found = series.select("series").distinct()
    origins = []
    for name, table in (("tuned", tuned), ("stored", stored)):
        if table is not None:
            one = table.groupBy("series").agg(F.min("params").alias(f"_{name}"))
            found = found.join(one, "series", "left")
            origins.append(name)
    params = F.coalesce(*[F.col(f"_{n}") for n in origins], F.lit(default))
    origin = F.coalesce(*[F.when(F.col(f"_{n}").isNotNull(), n) for n in origins], F.lit("default"))
    return found.select("series", params.alias("params"), origin.alias("origin"))
