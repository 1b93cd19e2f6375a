"""The three PM2.5 level scales (F2, F3, F4). They disagree on purpose and are kept separate:

* ``pm25_level`` — 5 code names; a missing value fails every comparison and lands in "hazardous";
  0 is "safe".
* ``aqi_category`` — 5 labels on right-closed bins starting above 0; 0, negatives and missing values get
  NULL.
* ``display_level`` — 6 display labels (adds a 250 break); 55-150 is "Unhealthy" here but
  "very_unhealthy" in the code names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolake.schema import AQI_EDGES, AQI_LABELS, DISPLAY_LEVELS, LEVEL_BOUNDS, LEVEL_NAMES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pm25_level(c) -> Column:
    """inclusive upper bounds, ``otherwise`` catches values above the last bound and NULL."""
    x = _col(c)
    expr = None
    for bound, name in zip(LEVEL_BOUNDS, LEVEL_NAMES):
        expr = F.when(x <= bound, name) if expr is None else expr.when(x <= bound, name)
    return expr.otherwise(LEVEL_NAMES[-1])


def aqi_category(c) -> Column:
    """bins (lo, hi]; no ``otherwise`` so anything outside every bin (0, negative, NULL) is NULL."""
    x = _col(c)
    expr = None
    for lo, hi, label in zip(AQI_EDGES[:-1], AQI_EDGES[1:], AQI_LABELS):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def _display(c, field: int) -> Column:
    x = _col(c)
    expr = None
    for row in DISPLAY_LEVELS:
        bound, value = row[0], row[field]
        if bound is None:
            return expr.otherwise(value)
        expr = F.when(x <= bound, value) if expr is None else expr.when(x <= bound, value)
    return expr


def display_level(c) -> Column:
    """F4 label. A missing value, like anything above 250, is "Hazardous"."""
    return _display(c, 1)


def display_level_columns(c) -> list[Column]:
    """F4 label, colour, emoji and advice as four aliased columns."""
    return [_display(c, 1).alias("level"), _display(c, 2).alias("color"),
            _display(c, 3).alias("emoji"), _display(c, 4).alias("advice")]
