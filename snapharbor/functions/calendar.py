"""Calendar parts of a date, as the date tables show them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(col: Column) -> list[Column]:
    return [
        F.year(col).alias("year"),
        F.month(col).alias("month_no"),
        F.date_format(col, "MMMM").alias("month"),
        F.quarter(col).alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter(col).cast("string")).alias("quarter"),
        F.dayofmonth(col).alias("day"),
    ]
