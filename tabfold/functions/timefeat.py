"""Cyclical calendar features (native expressions)."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO_PI = 2.0 * math.pi

# fixed values: strftime directive -> Java DateTimeFormatter pattern
_STRFTIME = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm",
             "%S": "ss", "%f": "SSSSSS", "%p": "a", "%b": "MMM", "%B": "MMMM", "%a": "EEE",
             "%A": "EEEE", "%j": "DDD", "%z": "Z", "%%": "%"}


def java_pattern(fmt: str) -> str:
    """Translate a strftime format into a Spark datetime pattern."""
    out, i = [], 0
    for m in re.finditer(r"%.|[^%]+", fmt):
        tok = m.group(0)
        if tok.startswith("%"):
            if tok not in _STRFTIME:
                raise ValueError(f"unsupported directive {tok}")
            out.append(_STRFTIME[tok])
        else:
            out.append("'" + tok.replace("'", "''") + "'" if re.search(r"[A-Za-z]", tok) else tok)
        i = m.end()
    return "".join(out)


def parse_time(c: Column | str, fmt: str | None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(java_pattern(fmt))) if fmt else col


def day_number(c: Column | str) -> Column:
    """Integers pass through; dates/timestamps become days since 1970-01-01."""
    col = F.col(c) if isinstance(c, str) else c
    return F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date"))


def _wave(x: Column, period: float):
    a = F.lit(TWO_PI) * x.cast("double") / F.lit(float(period))
    return F.sin(a), F.cos(a)


def yearly_features(df: DataFrame, col: str, date_format: str | None = None) -> DataFrame:
    """dayofyear = d mod 365, dayofweek = d mod 7, month = (d mod 365) // 31, + sin/cos.

    ``d`` is an integer day number; date or timestamp columns (or strings with
    ``date_format``) are converted to days since the epoch.  mod is
    non-negative (``pmod``), as in Python.
    """
    dt = df.schema[col].dataType
    if date_format is not None:
        d = day_number(parse_time(col, date_format))
    elif isinstance(dt, (T.IntegralType,)):
        d = F.col(col).cast("bigint")
    else:
        d = day_number(col)
    doy, dow = F.pmod(d, F.lit(365)), F.pmod(d, F.lit(7))
    month = F.floor(doy / 31).cast("bigint")
    s7, c7 = _wave(dow, 7)
    s365, c365 = _wave(doy, 365)
    s12, c12 = _wave(month, 12)
    return df.withColumns({"dayofyear": doy, "dayofweek": dow, "month": month,
                           "sin_dayofweek": s7, "cos_dayofweek": c7, "sin_day": s365, "cos_day": c365,
                           "sin_month": s12, "cos_month": c12})


def daily_features(df: DataFrame, col: str, seconds: bool = False, time_format: str | None = None) -> DataFrame:
    """hour, minute (and seconds) with sin/cos on periods 24, 60 (and 60)."""
    t = parse_time(col, time_format)
    new = {"hour": F.hour(t), "minute": F.minute(t)}
    if seconds:
        new["seconds"] = F.second(t)
    out = df.withColumns(new)
    hs, hc = _wave(F.col("hour"), 24)
    ms, mc = _wave(F.col("minute"), 60)
    waves = {"hour_sin": hs, "hour_cos": hc, "minute_sin": ms, "minute_cos": mc}
    if seconds:
        ss, sc = _wave(F.col("seconds"), 60)
        waves.update({"seconds_sin": ss, "seconds_cos": sc})
    return out.withColumns(waves)
