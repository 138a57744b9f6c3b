"""The semantic layer: measures over the overview and fuel tables.

A filter or group on an overview column restricts the fuel table too; one on a fuel
column leaves the overview alone, because the relationship filters one way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapharbor.functions.calendar import calendar_parts

SNAPSHOT = "vehicle_snapshot_key"


@dataclass(frozen=True)
class Measure:
    table: str
    column: Column


def _vehicles() -> Column:
    return F.sum(F.col("vehicle_count").cast("long"))


def _multi_fuel() -> Column:
    """0 when vehicles exist but none qualifies, NULL when there is no vehicle."""
    qualifying = F.sum(
        F.when(F.col("fuel_record_count") > 1, F.col("vehicle_count").cast("long"))
    )
    return F.when(_vehicles().isNotNull(), F.coalesce(qualifying, F.lit(0).cast("long")))


def _coverage(col: str) -> Column:
    """0 when rows exist but none reports, NULL when there is no row."""
    return F.try_divide(F.count(col), F.count(F.lit(1)))


def measures() -> dict[str, Measure]:
    return {
        "vehicles": Measure("overview", _vehicles()),
        "multi_fuel_vehicles": Measure("overview", _multi_fuel()),
        "multi_fuel_share": Measure("overview", F.try_divide(_multi_fuel(), _vehicles())),
        "snapshot_started_at": Measure("overview", F.max("snapshot_started_at")),
        "fuel_records": Measure("fuel", F.count(F.lit(1))),
        "vehicles_with_fuel": Measure("fuel", F.countDistinct(SNAPSHOT)),
        "avg_co2": Measure("fuel", F.avg("co2_combined_g_km")),
        "avg_power": Measure("fuel", F.avg("net_max_power_kw")),
        "co2_coverage": Measure("fuel", _coverage("co2_combined_g_km")),
        "power_coverage": Measure("fuel", _coverage("net_max_power_kw")),
    }


def check_filters(filters: dict[str, list] | None, *tables: DataFrame) -> dict[str, list]:
    """The filters, if each of them is a column of one of the tables."""
    unknown = [c for c in filters or {} if not any(c in t.columns for t in tables)]
    if unknown:
        raise ValueError(f"no table has the filters {unknown}")
    return filters or {}


def slicer(df: DataFrame, filters: dict[str, list]) -> DataFrame:
    """Rows whose columns hold one of the chosen values; other columns are ignored."""
    for column, values in filters.items():
        if column in df.columns:
            df = df.where(F.col(column).isin(*values))
    return df


def rel_filter(fuel: DataFrame, overview: DataFrame) -> DataFrame:
    """Fuel rows whose snapshot is in the (filtered) overview.

    The snapshot key is unique on the overview side, so no distinct is needed.
    """
    return fuel.join(overview.select(SNAPSHOT), SNAPSHOT, "left_semi")


def _group(df: DataFrame, by: list[str], rollup: bool, aggs: list[Column]) -> DataFrame:
    if not rollup:
        return df.groupBy(*by).agg(*aggs)
    return df.rollup(*by).agg(F.grouping_id().cast("int").alias("level"), *aggs)


def measure(
    overview: DataFrame,
    fuel: DataFrame,
    names: list[str],
    by: tuple[str, ...] = (),
    filters: dict[str, list] | None = None,
    rollup: bool = False,
) -> DataFrame:
    """Measures per group. All names must belong to one of the two tables.

    ``rollup`` adds subtotals with their grouping level; distinct counts are recomputed
    per level, never added up.
    """
    known = measures()
    tables = {known[n].table for n in names}
    if len(tables) != 1:
        raise ValueError("evaluate overview and fuel measures separately")
    filters = check_filters(filters, overview, fuel)
    aggs = [known[n].column.alias(n) for n in names]
    groups = list(by)
    if tables == {"overview"}:
        missing = [c for c in groups if c not in overview.columns]
        if missing:
            raise ValueError(f"overview measures do not vary by {missing}")
        return _group(slicer(overview, filters), groups, rollup, aggs)
    rows = slicer(fuel, filters)
    borrowed = [c for c in groups if c not in fuel.columns]
    parents = slicer(overview, filters)
    if borrowed:
        rows = rows.join(parents.select(SNAPSHOT, *borrowed), SNAPSHOT)
    elif any(c in overview.columns for c in filters):
        rows = rel_filter(rows, parents)
    return _group(rows, groups, rollup, aggs)


def powertrain_share(
    overview: DataFrame,
    by: tuple[str, ...] = ("powertrain_category",),
    filters: dict[str, list] | None = None,
) -> DataFrame:
    """Vehicles over the vehicles counted with the powertrain filter taken away.

    Rows are counted once per (other groups, category); numerator and denominator are
    sums of those cells. A window over them holds one row per category.
    """
    lifted = "powertrain_category"
    filters = check_filters(filters, overview)
    others = [c for c in by if c != lifted]
    kept = {c: v for c, v in filters.items() if c != lifted}
    chosen = F.col(lifted).isin(*filters[lifted]) if lifted in filters else F.lit(True)
    cells = slicer(overview, kept).groupBy(*others, lifted).agg(_vehicles().alias("_n"))
    if lifted in by:
        whole = F.sum("_n").over(Window.partitionBy(*others))
        shares = cells.select(
            *by, F.col("_n").alias("vehicles"), F.try_divide("_n", whole).alias("share")
        )
        return shares.where(chosen)
    sums = cells.groupBy(*others).agg(
        F.sum(F.when(chosen, F.col("_n"))).alias("vehicles"), F.sum("_n").alias("_whole")
    )
    return sums.where(F.col("vehicles").isNotNull()).select(
        *others, "vehicles", F.try_divide("vehicles", "_whole").alias("share")
    )


def calendar_dim(df: DataFrame, date_col: str) -> DataFrame:
    """Every day from 1 January of the first year to 31 December of the last.

    Years lie between 1 and 9999, which bounds the table at 3.7 million rows.
    """
    day = F.col(date_col).cast("date")
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = F.sequence(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
    )
    return span.select(F.explode(days).alias("date")).select(
        "date", *calendar_parts(F.col("date"))
    )


def date_part_join(df: DataFrame, ts_col: str, calendar: DataFrame, rows: str) -> DataFrame:
    """Row counts per calendar day, matched on the date part of a timestamp.

    Rows are counted per day first, so the join sees at most one row per day.
    """
    per_day = df.groupBy(F.col(ts_col).cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias(rows)
    )
    return calendar.join(per_day, "date")


def date_hierarchy(df: DataFrame, date_col: str, total: Column, name: str) -> DataFrame:
    """Year, quarter, month, day drill-down with subtotals.

    Values are added up per day first; the expansion into levels then multiplies
    days, not rows.
    """
    day = F.col(date_col).cast("date")
    per_day = df.where(day.isNotNull()).groupBy(day.alias("_d")).agg(total.alias("_n"))
    parts = per_day.select(
        F.year("_d").alias("year"),
        F.quarter("_d").alias("quarter"),
        F.month("_d").alias("month"),
        F.dayofmonth("_d").alias("day"),
        "_n",
    )
    return parts.rollup("year", "quarter", "month", "day").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("_n").alias(name)
    )
