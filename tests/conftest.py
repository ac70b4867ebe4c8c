import pytest

from almanack.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def series_frame(spark):
    """A panel from ``{series: [values]}``, one day per value from 2019-01-01."""
    from datetime import date, timedelta

    def build(data, start=date(2019, 1, 1)):
        rows = [
            (name, start + timedelta(days=i), None if v is None else float(v))
            for name, values in data.items()
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, "series string, date date, value double")

    return build
