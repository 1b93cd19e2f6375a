"""Labels and small arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolake.schema import STATION_CODE_PREFIX, STATION_DISPLAY_PREFIX, WEEKDAY_NAMES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_label(year="year", month="month") -> Column:
    """``YYYY-MM`` with a zero-padded month."""
    return F.concat_ws("-", _col(year).cast("string"), F.lpad(_col(month).cast("string"), 2, "0"))


def station_display_name(c="station_id") -> Column:
    """``site_101`` -> ``Station 101`` (every occurrence of the prefix is replaced)."""
    return F.replace(_col(c), F.lit(STATION_CODE_PREFIX), F.lit(STATION_DISPLAY_PREFIX))


def weekday_name(dow="dow") -> Column:
    """0 = Mon ... 6 = Sun."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_NAMES]), _col(dow).cast("int") + 1)


def hour_label(hour="hour") -> Column:
    """``HH:00``."""
    return F.format_string("%02d:00", _col(hour).cast("int"))


def step_label(step="step") -> Column:
    """``+Nh`` forecast step label."""
    return F.format_string("+%dh", _col(step).cast("int"))


def clip_lower(c, lower: float = 0.0) -> Column:
    """clip below at ``lower``; NULL stays NULL."""
    x = _col(c)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(x, F.lit(float(lower))))


def minmax_scale(c, lo: Column, hi: Column) -> Column:
    """(x - min) / (max - min); NULL when the range is empty."""
    return (_col(c) - lo) / F.nullif(hi - lo, F.lit(0.0))


def minmax_unscale(c, lo: Column, hi: Column) -> Column:
    """F10 inverse: x * (max - min) + min."""
    return _col(c) * (hi - lo) + lo


def pct(part, whole) -> Column:
    """part / whole * 100, NULL for an empty whole."""
    return _col(part).cast("double") / F.nullif(_col(whole).cast("double"), F.lit(0.0)) * 100.0


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """text -> zone-less timestamp. ISO-8601 with a trailing ``Z`` or an offset is converted to UTC
    wall-clock time (the session time zone must be UTC)."""
    x = _col(c)
    ts = F.to_timestamp(x, fmt) if fmt else F.to_timestamp(x)
    return ts.cast("timestamp_ntz")


def thousands(c) -> Column:
    """integer with thousands separators (``5,831,431``)."""
    return F.format_number(_col(c).cast("double"), 0)
