"""Row-based features along a series."""

from pyspark.sql import functions as F

from almanack.operators.panel import by_date, running
from almanack.settings import RUN_WRAP


def with_lags(df, columns, k, keys=("series",)):
    """``<column>_lag1 … _lagk`` by row; all share one window."""
    w = by_date(*keys)
    return df.withColumns(
        {f"{c}_lag{i}": F.lag(c, i).over(w) for c in columns for i in range(1, k + 1)}
    )


def with_run_lengths(df, events, keys=("series",), wrap=RUN_WRAP, lagged=False):
    """Length of the current run of events, 0 off the event, back to 0 at ``wrap``.

    ``events`` maps a new column to a boolean; an unknown event ends the run.
    The run is the distance to the last row without the event.
    """
    w = by_date(*keys)
    names = list(events)
    happens = {n: F.coalesce(events[n], F.lit(False)) for n in names}
    df = df.withColumn("_row", F.row_number().over(w))
    df = df.withColumns(
        {n: F.max(F.when(~happens[n], F.col("_row"))).over(running(w)) for n in names}
    )
    df = df.withColumns(
        {n: (F.col("_row") - F.coalesce(F.col(n), F.lit(0))) % wrap for n in names}
    )
    if lagged:
        df = df.withColumns({n: F.lag(n).over(w) for n in names})
    return df.drop("_row")


def skip_first(df, k, keys=("series",)):
    """Without the first ``k`` rows of each series (their lags are incomplete)."""
    w = by_date(*keys)
    return df.withColumn("_row", F.row_number().over(w)).where(F.col("_row") > k).drop("_row")


def with_code_lag(df, code="year_type_for_doy", keys=("series",)):
    """Replace a looked-up code by the previous row's, 0 where it had none.

    The same-day code would leak the outcome, so only the lag is kept.
    """
    w = by_date(*keys)
    return (
        df.withColumn(code, F.coalesce(F.col(code), F.lit(0)))
        .withColumn(f"{code}_lag1", F.lag(code).over(w))
        .drop(code)
    )


def with_cluster_lag(df, clusters, keys=("series",)):
    """Join ``(series, year, DoY, year_type_for_doy)`` and keep yesterday's code."""
    return with_code_lag(df.join(clusters, [*keys, "year", "DoY"], "left"), keys=keys)
