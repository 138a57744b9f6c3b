"""Column expressions that clean and parse raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a full Unicode strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove all leading and trailing whitespace (SQL ``trim`` removes spaces only).

    Trimming a set of characters looks each of them up; text whose ends are visible ASCII once its spaces
    are gone needs none of that.
    """
    text = F.trim(col)
    visible = [F.substring(text, at, 1).between(F.lit("!"), F.lit("~")) for at in (1, -1)]
    return F.when(visible[0] & visible[1], text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def not_blank(col: Column) -> Column:
    """True for text with at least one non-whitespace character; false for NULL."""
    return F.coalesce(F.length(strip(col)) > 0, F.lit(False))


def clean_text(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def clean_upper(col: Column) -> Column:
    return F.nullif(F.upper(strip(col)), F.lit(""))


def default_text(col: Column, default: str) -> Column:
    return F.coalesce(clean_text(col), F.lit(default))


def parse_compact_date(col: Column) -> Column:
    """Eight ASCII digits forming a calendar date of year 1 or later, else NULL."""
    text = strip(col)
    return F.when(
        text.rlike("^[0-9]{8}$") & ~text.startswith("0000"),
        F.try_to_date(text, "yyyyMMdd"),
    )


def parse_decimal_comma(col: Column) -> Column:
    """Plain decimal text, comma or point, as DOUBLE; anything else is NULL.

    The pattern keeps out ``NaN``, ``Infinity`` and Java suffixes such as ``12d``.
    """
    text = F.replace(strip(col), F.lit(","), F.lit("."))
    return F.when(
        text.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"),
        text.try_cast("double"),
    )


def parse_int_default(col: Column, default: int = 1) -> Column:
    """Whole number, where missing, invalid and zero all become ``default``."""
    text = strip(col)
    value = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))
    return F.coalesce(F.nullif(value, F.lit(0)), F.lit(default))


def blank_to_null(col: Column) -> Column:
    """The typed views trim spaces only, as SQL does."""
    return F.nullif(F.trim(col.cast("string")), F.lit(""))


def round_half_away(col: Column, digits: int) -> Column:
    """Round a DOUBLE by scaling, so that both engines agree on binary fractions."""
    scale = F.lit(float(10**digits))
    return F.round(col * scale) / scale
