"""Scalar column functions (all JVM-side built-ins, no Python UDFs).

Timestamps are handled as TIMESTAMP_NTZ (parquet timestamps without zone read that
way), so none of these depend on the session time zone.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lsn_to_bytes(lsn) -> Column:
    """WAL position text ``'HI/LO'`` (two hex words) -> byte offset, decimal(20,0).

    NULL in, NULL out.  ``16/B374D848`` -> 97500059720.
    """
    lsn = _c(lsn)
    hi = F.conv(F.split(lsn, "/").getItem(0), 16, 10).cast("decimal(20,0)")
    lo = F.conv(F.split(lsn, "/").getItem(1), 16, 10).cast("decimal(20,0)")
    return (hi * F.lit(_TWO_32).cast("decimal(20,0)") + lo).cast("decimal(20,0)")


def lsn_diff(a, b) -> Column:
    """Bytes between two WAL positions (a - b), as bigint; negative when a < b."""
    if isinstance(b, str) and "/" in b:
        b = F.lit(b)
    if isinstance(a, str) and "/" in a:
        a = F.lit(a)
    return (lsn_to_bytes(a) - lsn_to_bytes(b)).cast("bigint")


def micros_between(later, earlier) -> Column:
    """Exact microseconds from ``earlier`` to ``later`` (bigint)."""
    return F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))


def seconds_between(later, earlier) -> Column:
    """Seconds (double, microsecond precision) from ``earlier`` to ``later``."""
    return micros_between(later, earlier) / F.lit(1000000.0)


def _div(a, b) -> Column:
    """Integer quotient of two bigint columns, truncated towards zero (never through a double)."""
    return F.call_function("div", a, b)


def _round_half_away(num: Column, den: int) -> Column:
    """round(num / den) to an integer, halves away from zero, exact integer maths."""
    num = num.cast("bigint")
    mag = _div(F.abs(num) + F.lit(den // 2).cast("bigint"), F.lit(den).cast("bigint"))
    return F.when(num < 0, -mag).otherwise(mag)


def whole_seconds_between(later, earlier) -> Column:
    """Interval rounded to whole seconds (``::INTERVAL(0)`` / ``round(extract(epoch …))``)."""
    return _round_half_away(micros_between(later, earlier), 1000000)


def round_to_second(ts) -> Column:
    """``::TIMESTAMP(0)``: round a timestamp half up to the whole second, without time zone
    (a zoned value is first taken as wall-clock time in the session zone)."""
    # built from the wall-clock fields, so no value passes through the session zone (a
    # time inside a daylight-saving gap would otherwise move by an hour)
    t = _c(ts).cast("timestamp_ntz")
    minute = F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.lit(0))
    seconds = F.floor(F.date_part(F.lit("SECOND"), t) + F.lit(0.5)).cast("int")
    return F.timestamp_add("SECOND", seconds, minute)


def round_ratio(num, den, scale: int = 2) -> Column:
    """round(num / den, scale) for non-negative integer columns, exactly, half up.

    Computed in integer arithmetic (like a NUMERIC division) and returned as double,
    so the result does not depend on binary floating point ties.  den <= 0 -> NULL.
    """
    num, den = _c(num).cast("bigint"), _c(den).cast("bigint")
    den = F.when(den > 0, den)
    p = 10 ** scale
    # whole part and remainder apart, so that only the remainder is scaled up
    fraction = _div(num % den * F.lit(2 * p) + den, den * F.lit(2))
    return (_div(num, den) * F.lit(p) + fraction).cast("double") / F.lit(float(p))


def l2_distance(vec, query: Sequence[float]) -> Column:
    """Euclidean distance between an array<float> column and one fixed query vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    sq = F.zip_with(_c(vec), q, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))


def interval_micros(spark, text: str) -> int:
    """A Spark interval literal ('1 hour', '30 minutes', ...) in microseconds (a constant)."""
    return int(spark.sql(f"SELECT unix_micros(TIMESTAMP'1970-01-01 00:00:00 UTC' + INTERVAL {text}) AS m").first().m)


def floor_div(x, d: int) -> Column:
    """floor(x / d) for a bigint column and a positive constant, in exact integer arithmetic."""
    x = _c(x)
    return _div(x - F.pmod(x, F.lit(d)), F.lit(d).cast("bigint"))


# Fixed values of transaction ids: ids below 3 are special (invalid, bootstrap, frozen) and
# count as infinitely old; ids wrap around at 2^32.
_FIRST_NORMAL_XID = 3
_INT32_MAX = 2147483647


def xid_age(xid, current_xid) -> Column:
    """``age(xid)``: transactions from ``xid`` to ``current_xid`` on the 32-bit wraparound
    circle, as a signed 32-bit number; special ids (below 3) give the int32 maximum."""
    x, cur = _c(xid).cast("bigint"), _c(current_xid).cast("bigint")
    d = F.pmod(cur - x, F.lit(1 << 32))
    signed = F.when(d >= F.lit(1 << 31), d - F.lit(1 << 32)).otherwise(d)
    return F.when(x.isNull(), F.lit(None).cast("bigint")).when(
        x < F.lit(_FIRST_NORMAL_XID), F.lit(_INT32_MAX).cast("bigint")).otherwise(signed)
