"""Reading tables.  Readers take an explicit schema; nothing is inferred."""

import re
from functools import reduce

from pyspark.sql import functions as F


def read_csv(spark, paths, schema, **options):
    return spark.read.schema(schema).option("header", True).options(**options).csv(paths)


def read_table(spark, path):
    return spark.read.parquet(path)


def read_database(spark, url, table, predicate=None, partition_on=None, bounds=None,
                  parts=16, **options):
    """A database table with the predicate pushed into the database.

    With ``partition_on`` and its ``bounds`` the table is read by ``parts``
    concurrent range queries instead of one.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_on is not None:
        reader = reader.options(
            partitionColumn=partition_on, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=parts,
        )
    df = reader.load()
    return df if predicate is None else df.where(predicate)


def snake(name):
    """``Site Name``, ``siteName`` and ``site-name`` all become ``site_name``."""
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    return re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()


def clean_names(df):
    return df.toDF(*[snake(c) for c in df.columns])


def strip_names(df):
    return df.toDF(*[c.strip() for c in df.columns])


def stack_tagged(parts, tag="variable"):
    """Union of frames with differing columns, each tagged with its name.

    ``parts`` maps the tag to a frame or to a list of frames.
    """
    frames = []
    for name, group in parts.items():
        for df in group if isinstance(group, (list, tuple)) else [group]:
            frames.append(clean_names(df).withColumn(tag, F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
