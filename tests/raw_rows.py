"""Raw rows and table folders that several test modules use."""

import datetime as dt

from aerolake.schema import RAW_SCHEMA

SF_SMALL = "/root/testdata/sf0.001"


def _t(h):
    return dt.datetime(2024, 1, 1, h, 0, 0)


# The reference's 5-row mock: a negative value (row 1), a duplicate of row 0 (row 4), missing weather and an
# all-null column. NaN in the source frame is NULL here.
MOCK_ROWS = [
    ("site_101", "Delhi", "Delhi", "Alipur", "2024-01-01T00:00:00Z", _t(0), 10.5, 80.0, 1.2, 45.0, 0.0, 0.0, 10.0, 750.0, None, "pm25", 45.0, "Alipur", 2024, 1, 1, 0),
    ("site_101", "Delhi", "Delhi", "Alipur", "2024-01-01T01:00:00Z", _t(1), 12.0, 75.0, 1.5, 50.0, 0.0, 0.0, 50.0, 751.0, None, "pm25", -10.0, "Alipur", 2024, 1, 1, 1),
    ("site_102", "Delhi", "Delhi", "DTU", "2024-01-01T00:00:00Z", _t(0), None, 85.0, 0.8, 120.0, 0.0, 0.0, None, 749.0, None, "pm25", 12.0, "DTU", 2024, 1, 1, 0),
    ("site_102", "Delhi", "Delhi", "DTU", "2024-01-01T01:00:00Z", _t(1), 14.5, None, 1.0, 130.0, 0.0, 0.0, 40.0, 750.0, None, "pm10", 85.0, "DTU", 2024, 1, 1, 1),
    ("site_101", "Delhi", "Delhi", "Alipur", "2024-01-01T00:00:00Z", _t(0), 10.5, 80.0, 1.2, 45.0, 0.0, 0.0, 10.0, 750.0, None, "pm25", 45.0, "Alipur", 2024, 1, 1, 0),
]


def make_raw(spark, rows):
    """Rows given as dicts of non-default fields on top of a neutral raw row."""
    base = dict(zip(RAW_SCHEMA.names, MOCK_ROWS[0]))
    return spark.createDataFrame([tuple({**base, **r}[n] for n in RAW_SCHEMA.names) for r in rows], RAW_SCHEMA)
