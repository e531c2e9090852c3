"""Scalar column expressions.

All are JVM built-ins and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUND_DIGITS = 6


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded(x: Column | str, digits: int = ROUND_DIGITS) -> Column:
    """Round a double for stable comparison across engines."""
    return F.round(_c(x).cast("double"), digits)


def rounded_in_bulk(x: Column | str, digits: int = ROUND_DIGITS) -> Column:
    """The same value as ``rounded``, which goes through a decimal text, mostly
    without one: whole numbers are left, and the others are scaled and rounded
    to the nearest whole number where they are far from a tie. Its code is
    longer, so it is for rows too wide for whole-stage code."""
    v = _c(x).cast("double")
    scale = F.lit(float(10 ** digits))
    t = v * scale
    whole = F.rint(t)  # exact below 2**53; its quotient by a power of ten is the double nearest to the decimal
    clear = (F.abs(t) < 1e12) & (F.abs(F.abs(t - whole) - 0.5) > 1e-3)
    return (F.when(F.rint(v) == v, v + 0.0).when(clear, whole / scale + 0.0).otherwise(rounded(v, digits)))


def weekday0(d: Column | str) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d)).cast("long")


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """Division with floating-point semantics made explicit (ANSI mode
    raises on x/0): null operand -> null, 0/0 -> null, x/0 -> +-inf."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    inf = F.lit(float("inf"))
    return (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
            .when((d == 0) & (n == 0), F.lit(None).cast("double"))
            .when((d == 0) & (n > 0), inf)
            .when(d == 0, -inf)
            .otherwise(n / d))


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    """Full signed difference in hours of two timestamps."""
    return F.timestamp_diff("SECOND", _c(earlier), _c(later)).cast("double") / 3600.0


def lead_hours_mod24(later: Column | str, earlier: Column | str) -> Column:
    """Seconds component of a time difference in hours: whole days are
    dropped, so the result is always in [0, 24)."""
    secs = F.timestamp_diff("SECOND", _c(earlier), _c(later))
    return F.pmod(secs, F.lit(86400)).cast("double") / 3600.0


def area_token(area: Column | str, i: int) -> Column:
    """i-th blank-separated token (0-based) of an area name."""
    return F.split(_c(area), " ").getItem(i)


def id_store_key(id_col: Column | str) -> Column:
    """Store part of a ``prefix_store_yyyy-mm-dd`` id: all but the last token."""
    return F.substring_index(_c(id_col), "_", 2)


def id_date(id_col: Column | str) -> Column:
    """Date part (last ``_`` token) of a horizon id."""
    return F.to_date(F.substring_index(_c(id_col), "_", -1))


def fold_of(k: int, *key_cols: Column | str) -> Column:
    """Deterministic fold in [0, k): md5 of the natural key, first 32 bits,
    modulo k. Stable under repartitioning and task retries."""
    key = F.concat_ws("_", *[_c(c).cast("string") for c in key_cols])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % F.lit(k)).cast("long")
