"""Text to typed value; anything that does not parse becomes NULL."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# pattern letters -> digits they take
_PARTS = {"yyyy": 4, "MM": 2, "dd": 2, "HH": 2, "mm": 2, "ss": 2}

TIME_SHAPE = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"


def parse_number(c: Column, precision: int = 38, scale: int = 0) -> Column:
    """Decimal with half-up rounding, NULL for bad text or overflow."""
    return c.try_cast(f"decimal({precision},{scale})")


def _iso_text(c: Column, fmt: str) -> Column:
    """Reorder text of shape ``fmt`` to ISO order, NULL when it has another shape.

    Going through text keeps the value free of the session time zone, so a wall-clock
    time inside a daylight-saving gap is not shifted.
    """
    tokens = re.findall("yyyy|MM|dd|HH|mm|ss|.", fmt)
    order = [t for t in tokens if t in _PARTS]
    shape = "^" + "".join(rf"(\d{{{_PARTS[t]}}})" if t in _PARTS else re.escape(t) for t in tokens) + "$"
    # every token has a fixed width, so a text of this shape has them at fixed places
    at, places = 1, {}
    for t in tokens:
        places.setdefault(t, at)
        at += _PARTS.get(t, 1)
    part = lambda t: F.substring(c, places[t], _PARTS[t])
    iso = [part("yyyy"), F.lit("-"), part("MM"), F.lit("-"), part("dd")]
    if "HH" in order:
        iso += [F.lit(" "), part("HH"), F.lit(":"), part("mm"), F.lit(":"), part("ss")]
    return F.when(c.rlike(shape), F.concat(*iso))


# Fixed value: formats that are recognised by the text itself.
AUTO = "AUTO"


def _auto_text(c: Column) -> Column:
    """ISO text of a date or time stamp in any of the recognised shapes, else NULL.

    ISO with blank or T, fraction and offset (the wall clock counts); ``31-Jan-2024`` and
    ``01/31/2024``, both with an optional time; whole numbers count seconds since 1970, or
    thousandths, millionths or billionths of them when they are too large for that.
    """
    iso = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?:[T ].*)?$"), c)
    named = r"^(\d{1,2})-([A-Za-z]{3})-(\d{4})(.*)$"
    months = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
    at = F.instr(F.lit(months), F.upper(F.regexp_extract(c, named, 2)))
    month = F.when(at % 3 == 1, F.lpad(((at + 2) / 3).cast("int").cast("string"), 2, "0"))
    by_name = F.when(
        c.rlike(named),
        F.concat(F.regexp_extract(c, named, 3), F.lit("-"), month, F.lit("-"), F.regexp_extract(c, named, 1), F.regexp_extract(c, named, 4)),
    )
    slashed = r"^(\d{1,2})/(\d{1,2})/(\d{4})(.*)$"
    by_slash = F.when(c.rlike(slashed), F.regexp_replace(c, slashed, "$3-$1-$2$4"))
    count = F.when(c.rlike(r"^-?\d{1,18}$"), c.cast("decimal(38,0)"))
    size = F.abs(count)
    micros = (
        F.when(size < 31_536_000_000, count * 1_000_000)
        .when(size < 31_536_000_000_000, count * 1000)
        .when(size < 31_536_000_000_000_000, count)
        .otherwise(F.floor(count / 1000))
    ).cast("long")
    # counted from a stamp without zone, so that no session zone can shift it
    counted = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))
    return F.coalesce(iso, by_name, by_slash, counted.cast("string"))


def parse_timestamp(c: Column, fmt: str = "yyyy/MM/dd HH:mm:ss") -> Column:
    text = _auto_text(F.trim(c)) if fmt == AUTO else _iso_text(F.trim(c), fmt)
    return text.try_cast("timestamp_ntz")


def parse_date(c: Column, fmt: str = "yyyy/MM/dd") -> Column:
    if fmt == AUTO:
        return parse_timestamp(c, AUTO).cast("date")
    return _iso_text(F.trim(c), fmt).try_cast("date")


def parse_time_text(c: Column, auto: bool = False) -> Column:
    """``HH:mm:ss`` text that names a real time of day, else NULL.

    ``auto`` also takes times without seconds, with a fraction (dropped), and with AM or PM.
    """
    text = F.trim(c)
    if auto:
        shape = r"^(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\.\d+)?\s*([AaPp][Mm])?$"
        part = lambda n: F.regexp_extract(text, shape, n)
        hour, half = part(1).try_cast("int"), F.upper(part(4))
        hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "PM", 12).otherwise(0))
        second = F.when(part(3) == "", "00").otherwise(part(3))
        text = F.when(text.rlike(shape), F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), part(2), F.lit(":"), second))
    return F.when(text.rlike(TIME_SHAPE), text)
