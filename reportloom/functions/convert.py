"""Cell text to typed values. A value that does not convert becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANKS = " \t\r\n"

# The date forms reports use besides ISO. Month/day/year or month name first, then an optional clock.
OTHER_DATE = (r"^(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[A-Za-z]{3}\s+[0-9]{1,2}\s+[0-9]{4})"
              r"(?:\s+[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?\s*(?:[AaPp][Mm])?)?$")
DATE_PARTS = r"[/:\s]+|(?<=[0-9])(?=[AaPp])"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

def is_blank(cell: Column) -> Column:
    return F.btrim(cell, F.lit(BLANKS)) == ""


def empty_to_null(cell: Column) -> Column:
    return F.when(~is_blank(cell), cell)


def empty_kept(cell: Column) -> Column:
    """A blank cell becomes the empty text; a missing one stays NULL."""
    return F.when(is_blank(cell), "").otherwise(cell)


def _from_parts(parts: Column) -> Column:
    """Month, day, year, hour, minute, second, half of the day; the last three or four may be missing."""
    at = lambda index: F.get(parts, F.lit(index))
    named = (F.position(F.lower(at(0)), F.lit(MONTHS)) + 2) / 3
    month = F.coalesce(at(0).try_cast("int"), F.when(named == F.floor(named), named.cast("int")))
    half = F.upper(F.element_at(parts, -1))
    hour = F.coalesce(at(3).try_cast("int"), F.lit(0))
    hour = F.when(half.isin("AM", "PM"), hour % 12 + F.when(half == "PM", 12).otherwise(0)).otherwise(hour)
    second = F.coalesce(at(5).try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    return F.try_make_timestamp_ntz(at(2).try_cast("int"), month, at(1).try_cast("int"), hour,
                                    F.coalesce(at(4).try_cast("int"), F.lit(0)), second)


def to_datetime(cell: Column) -> Column:
    """ISO first; then month/day/year and month-name forms, which only the cells that hold them pay for.

    A lambda over the parts splits such a date once.
    """
    text = F.btrim(cell, F.lit(BLANKS))
    other = F.get(F.transform(F.array(F.split(text, DATE_PARTS)), _from_parts), F.lit(0))
    return F.coalesce(text.try_cast("timestamp_ntz"), F.when(text.rlike(OTHER_DATE), other))
