"""Column expressions shared by the plans.

All helpers return native Catalyst expressions (no Python UDFs), so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source model.
KM_PER_DEGREE = 111.0          # planar degrees -> km
DEFAULT_SPEED_KMH = 60.0       # speed assumed when an event carries none
DEVIATION_THRESHOLD_KM = 5.0   # route deviation alert threshold
LATE_AFTER = "2 hours"         # a delivery later than schedule + 2 h is late
ON_TIME_MAX_DELAY_MIN = 30     # delay_minutes <= 30 counts as on time
OPEN_VALID_TO = "2262-04-11"   # open-ended SCD2 validity end


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def full_name(first="first_name", last="last_name") -> Column:
    """``concat(first, ' ', last)`` with SQL-standard NULL-as-empty behaviour."""
    return F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "),
                    F.coalesce(_c(last), F.lit("")))


def address_city(address="delivery_address") -> Column:
    """City = trimmed text after the last comma of an address."""
    return F.trim(F.split_part(_c(address), F.lit(","), F.lit(-1)))


def weekday_label(ts) -> Column:
    """Upper-case English weekday, blank-padded to 9 characters."""
    return F.rpad(F.upper(F.date_format(_c(ts), "EEEE")), 9, " ")


def month_start(ts) -> Column:
    """First instant of the month, kept as a zone-less timestamp."""
    return F.date_trunc("month", _c(ts)).cast("timestamp_ntz")


def week_start(ts) -> Column:
    """Monday 00:00 of the ISO week, kept as a zone-less timestamp."""
    return F.date_trunc("week", _c(ts)).cast("timestamp_ntz")


def is_late(delivered="delivered_datetime", scheduled="scheduled_datetime") -> Column:
    """True when delivered after schedule + 2 h (NULL when either side is NULL)."""
    return _c(delivered) > _c(scheduled) + F.expr(f"INTERVAL {LATE_AFTER.split()[0]} HOURS")


def late_flag(delivered="delivered_datetime", scheduled="scheduled_datetime") -> Column:
    """1 when late else 0 (NULL timestamps give 0, like CASE WHEN ... ELSE 0)."""
    return F.when(is_late(delivered, scheduled), F.lit(1)).otherwise(F.lit(0))


def minutes_between(start, end) -> Column:
    """(end - start) in minutes as double."""
    return F.timestamp_diff("SECOND", _c(start), _c(end)) / F.lit(60.0)


def hours_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", _c(start), _c(end)) / F.lit(3600.0)


def round2(x, scale: int = 2) -> Column:
    """Decimal-style half-up rounding of a double.

    The value is first fixed to six decimals, then rounded, so the result does
    not depend on the binary representation (1.005 -> 1.01, as in exact
    numeric arithmetic).  Result is double.
    """
    return F.round(_c(x).cast("decimal(38,6)"), scale).cast("double")


def ratio(num, den) -> Column:
    """num / den in double; NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num, den, scale: int = 2) -> Column:
    """round(num / den * 100, scale) with a NULL for a zero divisor."""
    return round2(ratio(num, den) * F.lit(100.0), scale)


def dsum(x) -> Column:
    """Exact decimal sum in decimal(38,2). The input is widened before the
    sum, so a fact table of any size cannot overflow the default
    decimal(p+10) sum type (an error under ANSI mode)."""
    return F.sum(_c(x).cast("decimal(38,2)"))


def planar_km(lat1, lon1, lat2, lon2) -> Column:
    """Planar distance in km: sqrt(dlat^2 + dlon^2) * 111."""
    return F.sqrt(F.pow(F.abs(_c(lat1) - _c(lat2)), 2) + F.pow(F.abs(_c(lon1) - _c(lon2)), 2)) \
        * F.lit(KM_PER_DEGREE)


def nearest_waypoint_km(waypoints, lat, lon) -> Column:
    """Minimum planar distance to any waypoint; +inf for an empty/missing list."""
    dists = F.transform(_c(waypoints),
                        lambda w: planar_km(w["lat"], w["lon"], _c(lat), _c(lon)))
    return F.coalesce(F.array_min(dists), F.lit(float("inf")))


def iso_text(ts) -> Column:
    """ISO-8601 text with microseconds."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def yyyymmdd(ts) -> Column:
    """Integer date key such as 20010731."""
    return F.date_format(_c(ts), "yyyyMMdd").cast("int")


def hour_key(ts) -> Column:
    """Time key HH00 of a timestamp (hour * 100)."""
    return F.hour(_c(ts)) * F.lit(100)


def zero_pad_code(prefix: str, n, width: int) -> Column:
    """'R' + number zero-padded to at least ``width`` digits (R007, R1234)."""
    s = _c(n).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s))

