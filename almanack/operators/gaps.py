"""Filling holes in one source from others, in order of preference."""

from functools import reduce

from pyspark.sql import functions as F


def coalesce_sources(base, fallbacks, keys=("series", "date"), start=None, end=None):
    """All of ``base`` plus rows of each fallback on keys still without a value.

    A key counts as covered once an earlier source has a non-null value for it,
    and only days of the scaffold ``start … end`` are ever filled.  The covered
    keys are deduplicated before the anti join, so its right side holds at most
    one row per key however many stations report.
    """
    taken = [base]
    for fallback in fallbacks:
        covered = (
            reduce(lambda a, b: a.unionByName(b), [t.where("value IS NOT NULL").select(*keys) for t in taken])
            .distinct()
        )
        wanted = fallback
        if start is not None:
            wanted = wanted.where(F.col("date") >= F.lit(start))
        if end is not None:
            wanted = wanted.where(F.col("date") <= F.lit(end))
        taken.append(wanted.join(covered, list(keys), "left_anti"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), taken)
