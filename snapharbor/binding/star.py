"""The snapshot model bound to a star schema of orders and line items.

An order plays the vehicle, its line items play the fuel records, and the year of the
order names the ingestion run.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapharbor.functions.keys import salted_sha256
from snapharbor.operators.upsert import keep_last
from snapharbor.plans import models as m
from snapharbor.plans.workflow import run_snapshot
from snapharbor.session import configure, materialize, scratch_path
from snapharbor.sources.publication import scan_published
from snapharbor.sources.tables import scan_staging, write_staging
from snapharbor.spec import PUBLISHED_RELATIONS, VEHICLE_SPEC

SALT = "fixture-salt"
SPEC = replace(VEHICLE_SPEC, salt=SALT)
# Orders and line items are joined by the order key; vehicles leave by its hash.
KEY = "order_key"


def run_of(ts: Column) -> Column:
    return F.concat(F.lit("run_"), F.year(ts).cast("string"))


def hashed(key: str) -> Column:
    """Order keys are primary keys, so never NULL."""
    text = F.col(key).cast("string")
    return salted_sha256(text, SALT, required=True).alias("vehicle_id_hash")


def fuel_name() -> Column:
    """Return flag and line status as one of four fuel names."""
    flag = F.col("l_returnflag")
    return (
        F.when(flag == "A", "Elektriciteit")
        .when(flag == "N", "Waterstof")
        .when(F.col("l_linestatus") == "O", "Benzine")
        .otherwise("Diesel")
    )


class StarBinding:
    """Lazy relations of one data folder; nothing is cached between queries."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark, steps=True)
        self.dir = sf_dir
        self._lines: DataFrame | None = None
        self._raw_lines: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # --- staging -----------------------------------------------------------------

    def orders(self, attributes: bool) -> DataFrame:
        """Orders, with nation and market segment of the customer if wanted."""
        orders = self.table("orders")
        if not attributes:
            return orders
        customers = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        nations = self.table("nation").select("n_nationkey", "n_name")
        return orders.join(
            customers, F.col("o_custkey") == F.col("c_custkey"), "left"
        ).join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")

    def vehicles(
        self, attributes: bool = True, keyed: bool = False, only: DataFrame | None = None
    ) -> DataFrame:
        """Staged vehicles; without ``attributes`` the customer join is left out, ``keyed`` rows
        still have the short key beside its hash, and ``only`` holds the short keys that are wanted."""
        orders = self.orders(attributes)
        if only is not None:
            orders = orders.join(only, F.col("o_orderkey") == F.col(KEY), "left_semi")
        named = [F.col("n_name").alias("brand"), F.col("c_mktsegment").alias("model")]
        day = F.to_date("o_orderdate")
        return orders.select(
            hashed("o_orderkey"),
            *([F.col("o_orderkey").alias(KEY)] if keyed else []),
            *(named if attributes else []),
            day.alias("registration_date"),
            F.year(day).alias("registration_year"),
            F.col("o_orderpriority").alias("primary_colour"),
            F.lit(None).cast("string").alias("secondary_colour"),
            F.col("o_orderstatus").alias("vehicle_type"),
            run_of(F.col("o_orderdate")).alias("ingestion_id"),
        )

    def lines(self) -> DataFrame:
        """Line items, one per (order, line number)."""
        order = [
            "l_shipdate",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_returnflag",
        ]
        if self._raw_lines is not None:
            return self._raw_lines
        return keep_last(
            self.table("lineitem"),
            ["l_orderkey", "l_linenumber"],
            [F.col(c) for c in order],
        )

    def share_raw_lines(self) -> None:
        """Store the de-duplicated line items with what their raw rows are made of, for anchors and
        detail rows."""
        if self._raw_lines is None:
            columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
            self._raw_lines = materialize(self.lines().select(*columns, "l_quantity", "l_tax"), "raw-lines")

    def share_lines(self) -> None:
        """Store the de-duplicated line items: profiles and fuel rows are then both read
        from there, and line items are scanned and de-duplicated once."""
        if self._lines is None:
            columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
            measures = ["l_quantity", "l_discount", "l_tax"]
            self._lines = materialize(self.lines().select(*columns, *measures), "lines")

    def fuels(
        self, lineage: bool = True, keyed: bool = False, only: DataFrame | None = None
    ) -> DataFrame:
        """Staged fuels; without ``lineage`` the join that finds the run is left out. ``only`` holds
        the short keys that are wanted: lines meet them before they have a hash, which need not move."""
        lines = self.lines() if self._lines is None else self._lines
        if only is not None:
            lines = lines.join(only, F.col("l_orderkey") == F.col(KEY), "left_semi")
        if lineage:
            runs = self.table("orders").select(
                F.col("o_orderkey").alias("l_orderkey"),
                run_of(F.col("o_orderdate")).alias("ingestion_id"),
            )
            lines = lines.join(runs, "l_orderkey")
        quantity = F.col("l_quantity")
        return lines.select(
            hashed("l_orderkey"),
            *([F.col("l_orderkey").alias(KEY)] if keyed else []),
            F.col("l_linenumber").alias("fuel_sequence"),
            fuel_name().alias("fuel_type"),
            F.when(F.col("l_linestatus") == "F", "Euro 6").alias("emission_code"),
            F.when(F.col("l_discount") > 0, quantity).alias("co2_combined_g_km"),
            F.when(F.col("l_tax") > 0, quantity).alias("net_max_power_kw"),
            F.when(F.col("l_linenumber") % 3 == 0, "OVC").alias("hybrid_class"),
            *(["ingestion_id"] if lineage else []),
        )

    def runs(self) -> DataFrame:
        """One run row per order year."""
        orders = self.table("orders")
        total = F.count(F.lit(1))
        first, last = F.min("o_orderdate"), F.max("o_orderdate")
        finished = F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
        urgent = F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0))
        year = F.year(F.col("o_orderdate"))
        grouped = orders.groupBy(year.alias("y")).agg(
            total.alias("n"),
            first.alias("first"),
            last.alias("last"),
            finished.alias("done"),
            urgent.alias("urgent"),
        )
        seconds = F.when(F.col("y") == 1995, 0.0).otherwise(F.col("n") / 8)
        return grouped.select(
            F.concat(F.lit("run_"), F.col("y").cast("string")).alias("ingestion_id"),
            F.col("first").cast("timestamp").alias("started_at"),
            F.col("last").cast("timestamp").alias("completed_at"),
            F.lit("succeeded").alias("status"),
            F.when(F.col("y") % 2 == 0, 0).otherwise(10000).alias("sample_limit"),
            F.col("n").cast("int").alias("vehicle_rows"),
            F.col("done").cast("int").alias("fuel_rows"),
            F.col("urgent").cast("int").alias("duplicate_payloads"),
            F.lit(None).cast("string").alias("error_message"),
            F.lit("resumable_snapshot").alias("ingestion_mode"),
            F.when(F.col("y") % 2 != 0, 10000).cast("long").alias("requested_limit"),
            F.lit(1000).alias("page_size"),
            F.ceil(F.col("n") / 1000).cast("int").alias("pages_requested"),
            (F.col("n") + F.col("done")).cast("long").alias("source_rows_received"),
            F.col("n").cast("long").alias("matched_vehicles"),
            (F.col("n") - F.col("done")).cast("long").alias("rejected_rows"),
            seconds.alias("active_duration_seconds"),
            (seconds + 1).alias("wall_clock_elapsed_seconds"),
            F.when(seconds > 0, (F.col("n") + F.col("done")) / seconds)
            .otherwise(0.0)
            .alias("processed_rows_per_second"),
            F.lit("completed").alias("checkpoint_status"),
            (F.col("y") % 3 == 0).alias("resumed"),
            F.when(F.col("y") % 3 == 0, 1).otherwise(0).alias("resume_count"),
        )

    def staging(self) -> dict[str, DataFrame]:
        return {
            "vehicles": self.vehicles(),
            "fuels": self.fuels(),
            "ingestion_runs": self.runs(),
        }

    # --- models ------------------------------------------------------------------

    # The typed views of keyed rows: joins and groups go by the short key, and the
    # hash is taken only where it is part of the result.

    def stg_vehicles(self, attributes: bool = True) -> DataFrame:
        return m.stg_vehicles(self.vehicles(attributes, keyed=True))

    def stg_fuels(self, lineage: bool = True) -> DataFrame:
        return m.stg_fuels(self.fuels(lineage, keyed=True))

    def stg_runs(self) -> DataFrame:
        return m.stg_ingestion_runs(self.runs())

    def keyed_profile(self) -> DataFrame:
        return m.type_profile(self.stg_fuels(lineage=False), SPEC, KEY)

    def profile(self) -> DataFrame:
        found = self.keyed_profile()
        return found.select(hashed(KEY), *[c for c in found.columns if c != KEY])

    def wide(self, attributes: bool = True, started: bool = True) -> DataFrame:
        """Vehicle snapshots, with their run start if wanted."""
        runs = self.stg_runs() if started else None
        return m.wide_snapshot(self.stg_vehicles(attributes), self.keyed_profile(), runs, KEY)

    def overview(self, attributes: bool = True, started: bool = True) -> DataFrame:
        """Overview mart, narrower by the columns that are left out."""
        return m.mart_ev_overview(self.wide(attributes, started), SPEC)

    def snapshot(self) -> DataFrame:
        return m.fact_vehicle_snapshot(self.wide(), SPEC)

    def fuel_fact(self) -> DataFrame:
        self.share_lines()
        wide = self.wide(attributes=False, started=False)
        return m.fact_vehicle_fuel(m.wide_fuels(self.stg_fuels(), wide, SPEC, KEY), SPEC)

    def metric_rows(self) -> DataFrame:
        """Fuel rows with the attributes that the metrics mart groups by."""
        self.share_lines()
        return m.wide_fuels(self.stg_fuels(), self.wide(started=False), SPEC, KEY)

    def metrics(self) -> DataFrame:
        return m.mart_ev_metrics(self.metric_rows(), KEY)

    def snapshot_staging(self) -> dict[str, DataFrame]:
        """Staging as a snapshot holds it: only vehicles with a wanted fuel."""
        self.share_lines()
        ids = materialize(self.keyed_profile().select(KEY), "profile_ids")
        return {
            "vehicles": self.vehicles(only=ids),
            "fuels": self.fuels(only=ids),
            "ingestion_runs": self.runs(),
        }

    def stored_models(self) -> dict[str, DataFrame]:
        """Models over stored staging tables."""
        root = scratch_path(self.spark, "staging")
        write_staging(self.snapshot_staging(), root)
        return m.build_models(scan_staging(self.spark, root), SPEC, write=True)

    def published(self) -> dict[str, DataFrame]:
        """The published set of a checked snapshot run."""
        root = scratch_path(self.spark, "published")
        staged = self.snapshot_staging()
        runs = staged.pop("ingestion_runs")
        run_snapshot(self.spark, staged, runs, root, SPEC)
        return {r: scan_published(self.spark, root, r) for r in PUBLISHED_RELATIONS}

    # --- raw text ----------------------------------------------------------------

    def raw_vehicles(self, attributes: bool = True) -> DataFrame:
        """Orders as untidy text: padding, blanks, wrong dates."""
        rows = self.orders(attributes)
        key = F.col("o_orderkey")
        day = F.date_format("o_orderdate", "yyyyMMdd")
        named = [
            F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("merk"),
            F.when(key % 10 == 3, " ").otherwise(F.col("c_mktsegment")).alias(
                "handelsbenaming"
            ),
        ]
        return rows.select(
            F.when(key % 50 == 0, "  ")
            .otherwise(F.concat(F.lit(" "), key.cast("string"), F.lit("\t")))
            .alias("kenteken"),
            *(named if attributes else []),
            F.when(key % 9 == 0, "20231399")
            .when(key % 9 == 1, "")
            .when(key % 9 == 2, None)
            .when(key % 9 == 3, "2023-1-1")
            .when(key % 9 == 4, F.concat(F.lit("\t"), day))
            .otherwise(day)
            .alias("datum_eerste_toelating"),
            F.lower("o_orderpriority").alias("eerste_kleur"),
            F.lit(None).cast("string").alias("tweede_kleur"),
            F.concat(F.lit(" "), F.col("o_orderstatus")).alias("voertuigsoort"),
        )

    def raw_fuels(self) -> DataFrame:
        """Line items as untidy text: comma decimals, wrong numbers, blanks."""
        line = F.col("l_linenumber")
        whole = F.col("l_quantity").cast("int").cast("string")
        return self.lines().select(
            F.when(F.col("l_partkey") % 97 == 0, "")
            .otherwise(F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit("\t")))
            .alias("kenteken"),
            F.when(line == 3, "0")
            .when(line == 5, "x")
            .when(line == 6, None)
            .otherwise(F.concat(F.lit(" "), line.cast("string")))
            .alias("brandstof_volgnummer"),
            F.when(F.col("l_suppkey") % 13 == 0, " ")
            .otherwise(F.concat(fuel_name(), F.lit(" ")))
            .alias("brandstof_omschrijving"),
            F.when(F.col("l_linestatus") == "F", " Euro 6").alias("emissiecode_omschrijving"),
            F.when(line % 5 == 0, "NaN")
            .when(line % 5 == 1, F.concat(whole, F.lit(",5")))
            .when(line % 5 == 2, "12d")
            .when(line % 5 == 3, whole)
            .otherwise("")
            .alias("co2_uitstoot_gecombineerd"),
            F.when(F.col("l_tax") > 0, F.concat(F.lit("+"), whole, F.lit(".25"))).alias(
                "nettomaximumvermogen"
            ),
            F.when(line % 3 == 0, " OVC").alias("klasse_hybride_elektrisch_voertuig"),
        )
