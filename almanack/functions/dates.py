"""Calendar columns."""

from pyspark.sql import functions as F


def bucket_by_dates(day, cuts):
    """How many of the cut dates ``day`` has reached: 0 … len(cuts)."""
    reached = F.lit(0)
    for cut in sorted(cuts):
        reached = reached + (day >= F.lit(cut)).cast("int")
    return reached


def with_calendar_parts(df, day="date"):
    """Add ``year, month, DoY`` and the ISO week as a double (``week_1``)."""
    d = F.col(day)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "DoY": F.dayofyear(d),
            "week_1": F.weekofyear(d).cast("double"),
        }
    )


def day_first(text):
    """Text such as ``31-12-1999`` or ``31/12/1999`` to a date; null if unreadable."""
    return F.try_to_date(F.translate(F.trim(text), "/.", "--"), "d-M-yyyy")


def date_of(year, month, day):
    return F.make_date(year, month, day)
