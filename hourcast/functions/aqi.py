"""AQI scalar functions as JVM-side column expressions (no Python UDF).

``pm25_to_aqi`` reproduces the published piecewise-linear EPA conversion,
including its input rounding to one decimal *of the exact binary value*
(``35.45`` is stored as 35.4500000000000028... and therefore rounds up), which
neither ``round`` (HALF_UP on the decimal string) nor ``bround`` reproduce.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourcast import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_1dp_exact(c) -> Column:
    """Round a double to one decimal the way the exact binary value rounds.

    10·x is split into the float ``s`` and its exact error ``e`` (two-sum of
    8x and 2x, both exact); only when ``s`` sits on a .5 tie does ``e`` decide.
    """
    x = _col(c).cast("double")
    a = x * F.lit(8.0)
    b = x * F.lit(2.0)
    s = a + b
    e = b - (s - a)
    fl = F.floor(s).cast("double")
    tie = (s - fl) == F.lit(0.5)
    r = (F.when(tie & (e > 0), fl + 1.0)
         .when(tie & (e < 0), fl)
         .otherwise(F.rint(s)))
    return r / F.lit(10.0)


def _segment(cr: Column) -> Column:
    """0-based breakpoint segment of a 1-dp concentration in [0, 500.4]."""
    seg = F.lit(0)
    for c_lo, _c_hi, _i_lo, _i_hi in C.PM25_BREAKPOINTS[1:]:
        seg = seg + (cr >= F.lit(c_lo)).cast("int")
    return seg


def pm25_to_aqi(c) -> Column:
    """PM2.5 concentration -> integer US AQI (NULL stays NULL, NaN -> 500).

    The segment's slope (i_hi - i_lo) / (c_hi - c_lo) is the same double the
    published formula computes; the AQI is rint(slope * (c - c_lo) + i_lo)."""
    x = _col(c).cast("double")
    cr = round_1dp_exact(x)
    bp = C.PM25_BREAKPOINTS
    slope = F.array(*[F.lit((i_hi - i_lo) / (c_hi - c_lo)) for c_lo, c_hi, i_lo, i_hi in bp])
    c_lo = F.array(*[F.lit(float(b[0])) for b in bp])
    i_lo = F.array(*[F.lit(float(b[2])) for b in bp])
    k = _segment(cr) + 1
    val = F.rint(F.element_at(slope, k) * (cr - F.element_at(c_lo, k)) + F.element_at(i_lo, k))
    top = bp[-1][1]
    return (F.when(x.isNull(), F.lit(None).cast("int"))
             .when(cr < 0, F.lit(0))
             .when(F.isnan(cr) | (cr > F.lit(top)), F.lit(500))
             .otherwise(val.cast("int")))


def aqi_level_index(aqi) -> Column:
    """AQI -> 0..5 level index (<0 -> Good, >500 -> Hazardous)."""
    a = _col(aqi)
    idx = F.lit(0)
    for upper, _label, _color in C.AQI_LEVELS[:-1]:
        idx = idx + (a > F.lit(upper)).cast("int")
    return F.when(a.isNotNull(), idx)


def pm25_level_index(c) -> Column:
    """Concentration -> level index directly from the rounded concentration.

    Equal to aqi_level_index(pm25_to_aqi(c)): AQI is monotone in the 1-dp
    concentration and each level is exactly one breakpoint segment (the last
    two segments and anything above 500.4 are Hazardous)."""
    x = _col(c).cast("double")
    cr = round_1dp_exact(x)
    idx = F.least(_segment(cr), F.lit(len(C.AQI_LEVELS) - 1))
    return (F.when(x.isNull(), F.lit(None).cast("int")).when(cr < 0, F.lit(0))
             .when(F.isnan(cr), F.lit(len(C.AQI_LEVELS) - 1)).otherwise(idx))


def _pick(idx: Column, values: list) -> Column:
    # the guard matters: element_at over non-null literals is planned as never NULL
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1))


def aqi_to_level(aqi) -> Column:
    """AQI -> struct(label, color)."""
    idx = aqi_level_index(aqi)
    return F.struct(_pick(idx, [lv[1] for lv in C.AQI_LEVELS]).alias("label"),
                    _pick(idx, [lv[2] for lv in C.AQI_LEVELS]).alias("color"))


def aqi_label(aqi) -> Column:
    return _pick(aqi_level_index(aqi), [lv[1] for lv in C.AQI_LEVELS])


def aqi_color(aqi) -> Column:
    return _pick(aqi_level_index(aqi), [lv[2] for lv in C.AQI_LEVELS])


def level_label(idx) -> Column:
    return _pick(_col(idx), [lv[1] for lv in C.AQI_LEVELS])


def pm25_level(c) -> Column:
    """Concentration -> level label (the composition used by every metric)."""
    return level_label(pm25_level_index(c))


def is_unhealthy_level(label) -> Column:
    return _col(label).isin(*C.UNHEALTHY_LEVELS)


def is_unhealthy(c) -> Column:
    """Concentration whose level is 'Unhealthy for Sensitive' or worse (AQI > 100)."""
    return is_unhealthy_level(pm25_level(c))
