"""Every operator as a query over the star tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapharbor.binding.star import KEY, SALT, SPEC, StarBinding, fuel_name, run_of
from snapharbor.functions import keys, text
from snapharbor.functions.calendar import calendar_parts
from snapharbor.operators import buckets, gates, joins, matching, paging, payloads, quality, scans
from snapharbor.operators import runs as run_ops
from snapharbor.operators import topn, upsert
from snapharbor.plans import contracts, ingestion, maintenance
from snapharbor.plans import measures as ms
from snapharbor.plans import models as m
from snapharbor.plans import normalize, reports
from snapharbor.session import materialize, scratch_path
from snapharbor.sources import publication, raw, tables
from snapharbor.spec import (
    DEFAULT_DETAIL_BATCH,
    DEFAULT_PAGE_SIZE,
    DEFAULT_SNAPSHOT_LIMIT,
    PLAIN_ID_COLUMNS,
    PUBLISHED_RELATIONS,
)
from snapharbor.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ID = SPEC.raw_id


def query(build: Callable[[StarBinding], DataFrame]) -> Callable[[StarBinding], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(StarBinding(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def _rows(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# === report aggregates ===========================================================


@query
def rpt_powertrain_mix(b):
    return reports.vehicles_by(b.overview(False, False), "powertrain_category")


@query
def rpt_top_brands(b):
    return reports.top_brands(b.overview(started=False))


@query
def rpt_powertrain_cards(b):
    cards = reports.vehicles_by(b.overview(False, False), "powertrain_category")
    return cards.orderBy(F.col("vehicles").desc(), "powertrain_category")


@query
def rpt_registration_year(b):
    return reports.vehicles_by(b.overview(False, False), "registration_year")


@query
def rpt_snapshot_started(b):
    over = b.overview(attributes=False)
    return ms.measure(over, over, ["snapshot_started_at"])


@query
def rpt_vehicle_total(b):
    over = b.overview(False, False)
    return ms.measure(over, over, ["vehicles"])


@query
def rpt_model_matrix(b):
    return reports.model_matrix(b.overview(started=False))


@query
def rpt_brand_by_powertrain(b):
    return reports.brand_by_powertrain(b.overview(started=False))


def _by_fuel(b, *names):
    fuel = b.fuel_fact()
    return ms.measure(fuel, fuel, list(names), by=("fuel_type",))


@query
def rpt_fuel_vehicles(b):
    return _by_fuel(b, "vehicles_with_fuel")


@query
def rpt_fuel_co2(b):
    return _by_fuel(b, "avg_co2")


@query
def rpt_fuel_power(b):
    return _by_fuel(b, "avg_power")


@query
def rpt_fuel_cards(b):
    fuel = b.fuel_fact()
    return reports.fuel_cards(fuel, fuel)


@query
def rpt_fuel_matrix(b):
    fuel = b.fuel_fact()
    return reports.fuel_matrix(fuel, fuel)


# === example analytic queries ====================================================


@query
def q_top_brands(b):
    return reports.q_top_brands(b.overview(started=False))


@query
def q_year_profile(b):
    return reports.q_year_profile(b.overview(False, False))


@query
def q_metrics_top50(b):
    return reports.q_metrics_top50(b.metrics())


@query
def q_snapshot_grain(b):
    wide = b.wide(attributes=False, started=False)
    return reports.q_snapshot_grain(
        wide.withColumnRenamed("ingestion_id", "snapshot_ingestion_id")
    )


@query
def q_run_audit(b):
    return reports.q_run_audit(b.runs())


# === measures ====================================================================


def _over(b, name, **kwargs):
    over = b.overview(attributes=False, started=name == "snapshot_started_at")
    return ms.measure(over, over, [name], **kwargs)


def _fuel(b, name):
    """Fuel measures by an overview column, with filters on both tables."""
    b.share_lines()
    over = b.overview(False, False)
    return ms.measure(
        over,
        b.fuel_fact(),
        [name],
        by=("powertrain_category", "fuel_type"),
        filters={"registration_year": [1996, 1997, 1998], "hybrid_class": ["OVC"]},
    )


@query
def m_vehicles(b):
    return _over(b, "vehicles", by=("vehicle_type",))


@query
def m_fuel_records(b):
    return _fuel(b, "fuel_records")


@query
def m_vehicles_with_fuel(b):
    return _fuel(b, "vehicles_with_fuel")


@query
def m_avg_co2(b):
    return _fuel(b, "avg_co2")


@query
def m_avg_power(b):
    return _fuel(b, "avg_power")


@query
def m_co2_coverage(b):
    return _fuel(b, "co2_coverage")


@query
def m_power_coverage(b):
    return _fuel(b, "power_coverage")


@query
def m_multi_fuel(b):
    return _over(b, "multi_fuel_vehicles", by=("powertrain_category", "vehicle_type"))


@query
def m_multi_fuel_share(b):
    return _over(b, "multi_fuel_share", by=("powertrain_category",))


@query
def m_powertrain_share(b):
    return ms.powertrain_share(
        b.overview(False, False),
        by=("vehicle_type", "powertrain_category"),
        filters={"powertrain_category": ["Battery electric", "Hybrid electric"]},
    )


@query
def m_snapshot_started(b):
    return _over(b, "snapshot_started_at", by=("powertrain_category",))


@query
def rel_filter(b):
    b.share_lines()
    over = ms.slicer(b.overview(False, False), {"powertrain_category": ["Hybrid electric"]})
    kept = ms.rel_filter(b.fuel_fact(), over)
    return kept.select("vehicle_snapshot_key", "vehicle_key", "fuel_sequence", "fuel_type")


@query
def slicer(b):
    return ms.slicer(
        b.overview(started=False),
        {
            "brand": ["NATION_1", "NATION_2", "NATION_12"],
            "vehicle_type": ["F", "O"],
            "registration_year": [1996, 1999],
        },
    )


@query
def calendar_dim(b):
    return ms.calendar_dim(b.vehicles(attributes=False), "registration_date")


@query
def date_hierarchy(b):
    return ms.date_hierarchy(
        b.overview(False, False), "registration_date", F.sum("vehicle_count"), "vehicles"
    )


@query
def date_part_join(b):
    days = ms.calendar_dim(b.table("events"), "ts")
    return ms.date_part_join(b.table("events"), "ts", days.select("date", "quarter"), "rows")


# === dimensions, facts and marts =================================================


@query
def dim_vehicle(b):
    return m.dim_vehicle(b.stg_vehicles(attributes=False))


@query
def dim_vehicle_model(b):
    return m.dim_vehicle_model(b.stg_vehicles(), SPEC)


@query
def dim_registration_date(b):
    return m.dim_registration_date(b.stg_vehicles(attributes=False))


@query
def dim_powertrain(b):
    return m.dim_powertrain(b.profile(), SPEC)


@query
def fact_vehicle_snapshot(b):
    return b.snapshot()


@query
def fact_vehicle_fuel(b):
    return b.fuel_fact()


@query
def mart_ev_overview(b):
    return b.overview()


@query
def mart_ev_metrics(b):
    return b.metrics()


@query
def star_overview(b):
    return m.star_overview(b.stored_models())


@query
def star_metrics(b):
    return m.star_metrics(b.stored_models())


# === staging views, intermediate models, keys ====================================


@query
def stg_vehicles(b):
    return b.stg_vehicles().drop(KEY)


@query
def stg_fuels(b):
    return b.stg_fuels().drop(KEY)


@query
def stg_ingestion_runs(b):
    return b.stg_runs()


@query
def int_vehicle_fuel_profile(b):
    return b.profile()


@query
def int_snapshot_context(b):
    return m.snapshot_context(b.vehicles(attributes=False), b.stg_runs())


@query
def md5_key(b):
    fuels = b.stg_fuels()
    return fuels.select(
        m.fuel_fact_key(SPEC).alias("fact_key"),
        keys.md5_key(F.col("vehicle_id_hash"), F.col("hybrid_class")).alias("null_key"),
    )


@query
def md5_key_nullsafe(b):
    fuels = b.stg_fuels(lineage=False)
    parts = [F.col("fuel_type"), F.col("emission_code"), F.col("hybrid_class")]
    return fuels.select(
        "vehicle_id_hash",
        "fuel_sequence",
        keys.md5_key(*parts, null_token=SPEC.null_token).alias("type_key"),
    )


@query
def md5_key_flags(b):
    return b.profile().select("vehicle_id_hash", m.powertrain_key(SPEC).alias("powertrain_key"))


@query
def date_key(b):
    day = F.when(F.col("o_orderkey") % 7 != 0, F.to_date("o_orderdate"))
    return b.table("orders").select("o_orderkey", keys.date_key(day).alias("date_key"))


# === data tests ==================================================================


@query
def dq_not_null(b):
    return quality.dq_not_null(b.stg_fuels(lineage=False), "emission_code").select(
        "vehicle_id_hash", "fuel_sequence"
    )


@query
def dq_unique(b):
    return quality.dq_unique(b.table("orders"), "o_custkey")


@query
def dq_unique_expr(b):
    key = F.concat(
        F.col("l_orderkey").cast("string"), F.lit(":"), F.col("l_linenumber").cast("string")
    )
    return quality.dq_unique_expr(b.table("lineitem"), key, "line_key")


@query
def dq_relationship(b):
    """Fuel rows whose vehicle has no electric or hydrogen profile."""
    return quality.dq_relationship(
        b.fuels(lineage=False), "vehicle_id_hash", b.profile(), "vehicle_id_hash"
    )


@query
def dq_accepted_values(b):
    return quality.dq_accepted_values(
        b.fuels(lineage=False), "fuel_type", ["Elektriciteit", "Waterstof", "Benzine"]
    )


@query
def dq_grain_reconcile(b):
    """All five count pairs, so that a pass shows its counts too."""
    return quality.count_reconcile(contracts.grain_pairs(b.stored_models()))


@query
def dq_model_contracts(b):
    """Every declared test of every model."""
    return contracts.contract_checks(b.stored_models())


@query
def dq_singular_tests(b):
    """Every test that spans models, over staging that also holds other vehicles."""
    root = scratch_path(b.spark, "staging")
    tables.write_staging(b.staging(), root)
    models = m.build_models(tables.scan_staging(b.spark, root), SPEC, write=True)
    return contracts.singular_checks(models, SPEC)


@query
def dq_fact_fuel_rowcount(b):
    return quality.count_mismatch(
        {"fact_vehicle_fuel": (b.fuels(lineage=False), b.fuel_fact())}
    ).select(
        F.col("expected_rows").alias("staging_rows"), F.col("actual_rows").alias("fact_rows")
    )


@query
def dq_fact_snapshot_rowcount(b):
    facts = m.fact_parents(b.wide(False, False), SPEC)
    return quality.count_mismatch(
        {"fact_vehicle_snapshot": (b.table("orders"), facts)}
    ).select(
        F.col("expected_rows").alias("staging_rows"), F.col("actual_rows").alias("fact_rows")
    )


@query
def dq_mart_recompute_diff(b):
    """The metrics mart against a recomputation from the star."""
    models = b.stored_models()
    return quality.multiset_diff(m.star_metrics(models), models["mart_ev_metrics"])


@query
def mart_ev_metrics_maintained(b):
    """The mart after two updates of its state: the first snapshot lacks some vehicles and the second
    has others with different measures and one brand renamed."""
    now = materialize(b.metric_rows().select(KEY, *m.METRIC_KEYS, *maintenance.MEASURES), "metric-rows")
    first = now.where(F.col(KEY) % 7 != 0)
    doubled = F.when(F.col(KEY) % 5 == 1, F.col("co2_combined_g_km") * 2).otherwise(F.col("co2_combined_g_km"))
    renamed = F.when(F.col(KEY) % 11 == 3, F.lit("RENAMED")).otherwise(F.col("brand"))
    second = now.withColumn("co2_combined_g_km", doubled).withColumn("brand", renamed)
    state = materialize(maintenance.metric_state(first, KEY), "state-1")
    state = materialize(maintenance.maintained_state(state, first, second, KEY), "state-2")
    return maintenance.metrics_of_state(maintenance.maintained_state(state, second, now, KEY))


@query
def dq_mart_recompute_drift(b):
    """A metrics mart that has lost the groups of one brand and holds those of another twice."""
    mart = b.metrics()
    brand = F.coalesce("brand", F.lit(""))
    drifted = mart.where(brand != "NATION_1").unionByName(mart.where(brand == "NATION_2"))
    return quality.multiset_diff(mart, drifted)


@query
def dq_no_plaintext_columns(b):
    """Rows exposed under a banned column name, raw input against staging."""
    relations = {
        "raw_fuels": b.raw_fuels(),
        "staged_fuels": b.fuels(lineage=False),
        "staged_vehicles": b.vehicles(attributes=False),
    }
    found = gates.banned_columns(relations, PLAIN_ID_COLUMNS)
    parts = [
        relations[t]
        .agg(F.count(c).alias("rows"))
        .select(F.lit(t).alias("relation"), F.lit(c).alias("column_name"), "rows")
        for t, c in found
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def dq_nonnegative_measures(b):
    """Labels of measures below a bound (account balances stand in for negatives)."""
    fuel = quality.dq_below(
        b.fuels(lineage=False),
        {
            "fact_vehicle_fuel.co2_combined_g_km": (F.col("co2_combined_g_km"), 0),
            "fact_vehicle_fuel.net_max_power_kw": (F.col("net_max_power_kw"), 0),
        },
    )
    profile = quality.dq_below(
        b.profile(), {"fact_vehicle_snapshot.fuel_record_count": (F.col("fuel_record_count"), 1)}
    )
    balance = quality.dq_below(
        b.table("customer"), {"customer.c_acctbal": (F.col("c_acctbal"), 0)}
    )
    return fuel.unionByName(profile).unionByName(balance)


@query
def dq_classification(b):
    """Profiles whose stored category (spoilt where fuels are many) fails recomputation."""
    spoilt = F.when(F.col("fuel_record_count") > 5, SPEC.battery_label).otherwise(
        F.col("powertrain_category")
    )
    stored = b.profile().withColumn("powertrain_category", spoilt)
    return gates.classification_violations(stored, m.powertrain_category(SPEC))


@query
def dq_date_range(b):
    """Order dates moved 99 years back where the order is urgent."""
    day = F.to_date("o_orderdate")
    moved = F.when(F.col("o_orderpriority") == "1-URGENT", F.add_months(day, -1188))
    dates = b.table("orders").select(F.coalesce(moved, day).alias("registration_date"))
    return quality.dq_date_range(dates, "registration_date")


# --- staging gate ----------------------------------------------------------------


def _dirty_staging(b):
    """Staging with NULL keys, malformed hashes, duplicates and impossible years."""
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("o_orderkey") % 20 == 5, 2).otherwise(1)))
    key = keys.salted_sha256(F.col("o_orderkey").cast("string"), SALT)
    vehicles = b.table("orders").select(
        F.when(F.col("o_orderkey") % 100 == 2, None)
        .when(F.col("o_orderkey") % 100 == 1, F.upper(key))
        .otherwise(key)
        .alias("vehicle_id_hash"),
        F.when(F.col("o_orderkey") % 50 == 7, 1850)
        .otherwise(F.year("o_orderdate"))
        .alias("registration_year"),
        copies.alias("copy"),
    )
    return vehicles.drop("copy"), b.fuels(lineage=False)


@query
def staging_gate(b):
    return gates.staging_gate(*_dirty_staging(b))


def _gate(b, check):
    return staging_gate(b).where(F.col("check") == check)


@query
def gate_null_keys(b):
    return _gate(b, "null_vehicle_hashes")


@query
def gate_duplicate_keys(b):
    return _gate(b, "duplicate_vehicles")


@query
def gate_orphans(b):
    return _gate(b, "orphan_fuels")


@query
def gate_plain_columns(b):
    vehicles, fuels = _dirty_staging(b)
    checks = gates.staging_gate(vehicles, fuels, {"raw_fuels": b.raw_fuels()})
    return checks.where(F.col("check") == "plain_identifier_columns")


@query
def gate_bad_hash(b):
    return _gate(b, "invalid_vehicle_hashes")


@query
def gate_year_range(b):
    return _gate(b, "invalid_registration_years")


@query
def gate_empty(b):
    return _gate(b, "empty_vehicle_staging")


# --- content scans ---------------------------------------------------------------

# Personal data and credentials as the document table writes them.
DOCUMENT_PATTERNS = {
    "e-mail address": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}", ("@",)),
    "IPv4 address": (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", ()),
    "long digit run": (r"[0-9]{10,}", ()),
    "hex token": (r"\b[0-9a-f]{32,}\b", ()),
    "licence line": (r"(?i)licen[sc]e", ()),
}


@query
def scan_patterns(b):
    patterns = {**scans.AUDIT_PATTERNS, **DOCUMENT_PATTERNS}
    return scans.scan_patterns(b.table("documents"), "doc_id", "text", patterns)


@query
def scan_paths(b):
    """Documents filed under their source, with endings of all kinds."""
    ending = F.element_at(
        F.array(*[F.lit(x) for x in (".md", ".parquet", ".LOG", ".py", "/.env")]),
        (F.col("doc_id") % 5 + 1).cast("int"),
    )
    folder = F.when(F.col("doc_id") % 3 == 0, "x/data/").otherwise("x/metadata/")
    name = F.concat(folder, F.col("source"), ending)
    return scans.scan_paths(b.table("documents").select("doc_id", name.alias("path")), "path")


@query
def scan_plaintext_values(b):
    """Published fuels are clean; line items that still carry the order key are not."""
    leaky = b.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("note"), "l_returnflag"
    )
    ids = b.table("orders").select(F.col("o_orderkey").cast("string").alias(ID))
    outputs = {"staged_fuels": b.fuels(lineage=False), "leaky_lines": leaky}
    return scans.scan_plaintext_values(outputs, ids, ID)


@query
def verify_expected(b):
    """Categories against those derived from the set of fuel names per order."""
    has = {
        n: F.max((fuel_name() == f).cast("int")) == 1
        for n, f in (("e", "Elektriciteit"), ("h", "Waterstof"))
    }
    other = F.max(fuel_name().isin("Benzine", "Diesel").cast("int")) == 1
    expected = (
        b.lines()
        .groupBy("l_orderkey")
        .agg(has["e"].alias("e"), has["h"].alias("h"), other.alias("o"))
        .where("e or h")
        .select(
            keys.salted_sha256(F.col("l_orderkey").cast("string"), SALT).alias(
                "vehicle_id_hash"
            ),
            F.when(F.col("h"), "Hydrogen electric")
            .when(F.col("o"), "Hybrid electric")
            .otherwise("Battery electric")
            .alias("powertrain_category"),
        )
    )
    # The raw line items hold repeated (order, line) rows: a deliberate finding.
    counts = {"lineitem": (b.table("lineitem"), 0)}
    # Fuels without a value keep NULL; the copy with zeros in their place is found.
    measures = ["co2_combined_g_km", "net_max_power_kw"]
    filled = b.fuels().fillna(0.0, measures)
    nulls = {"fuels": (b.fuels(), measures), "filled_fuels": (filled, measures)}
    return quality.verify_expected(b.profile(), expected, counts, nulls)


# === joins =======================================================================


@query
def join_inner_one_key(b):
    vehicles = b.vehicles(attributes=False).select("vehicle_id_hash", "vehicle_type")
    return vehicles.join(b.profile(), "vehicle_id_hash").select(
        "vehicle_id_hash", "vehicle_type", "fuel_record_count"
    )


@query
def join_inner_two_keys(b):
    vehicles = b.vehicles(attributes=False).select(
        "vehicle_id_hash", "ingestion_id", "registration_date"
    )
    return b.fuels().join(vehicles, ["vehicle_id_hash", "ingestion_id"]).select(
        "vehicle_id_hash", "ingestion_id", "fuel_sequence", "registration_date"
    )


@query
def join_left(b):
    """All vehicles, with a category where there is one."""
    vehicles = b.vehicles(attributes=False).select("vehicle_id_hash")
    profile = b.profile().select("vehicle_id_hash", "powertrain_category")
    return vehicles.join(profile, "vehicle_id_hash", "left")


@query
def join_anti(b):
    vehicles = b.vehicles(attributes=False).select("vehicle_id_hash", "ingestion_id")
    return joins.drop_ids(vehicles, b.fuels(lineage=False), "vehicle_id_hash")


@query
def join_semi(b):
    vehicles = b.vehicles(attributes=False).select("vehicle_id_hash", "ingestion_id")
    return joins.keep_ids(vehicles, b.fuels(lineage=False), "vehicle_id_hash")


@query
def join_semi_topn(b):
    """Overview rows of the ten largest brands."""
    over = b.overview(started=False).select("vehicle_snapshot_key", "brand", "vehicle_count")
    return joins.keep_ids(over, reports.top_brands(over), "brand")


@query
def join_exists_probe(b):
    """Every order, flagged when one of its lines was returned."""
    returned = b.table("lineitem").where(F.col("l_returnflag") == "R")
    keys_ = returned.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return b.table("orders").select("o_orderkey").join(
        keys_.withColumn("seen", F.lit(True)), "o_orderkey", "left"
    ).select("o_orderkey", F.coalesce("seen", F.lit(False)).alias("duplicate"))


@query
def join_count_pair(b):
    """Two scalar counts side by side."""
    return quality.count_reconcile({"orders": (b.table("orders"), b.table("lineitem"))})


# === aggregations ================================================================


@query
def agg_global(b):
    return b.fuels(lineage=False).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("co2_combined_g_km").alias("co2_rows"),
        F.countDistinct("vehicle_id_hash").alias("vehicles"),
        F.avg("co2_combined_g_km").alias("avg_co2"),
        F.sum("net_max_power_kw").alias("sum_power"),
        F.min("net_max_power_kw").alias("min_power"),
        F.max("net_max_power_kw").alias("max_power"),
    )


@query
def agg_group_two_keys(b):
    return b.fuels(lineage=False).groupBy("fuel_type", "hybrid_class").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("net_max_power_kw").alias("avg_power")
    )


@query
def agg_bool_or(b):
    """NULL inputs are skipped; all-NULL groups stay NULL."""
    kind = F.when(F.col("l_linestatus") == "F", F.col("l_returnflag"))
    return b.table("lineitem").groupBy("l_suppkey").agg(
        F.bool_or(kind == "A").alias("any_a"), F.bool_or(kind == "N").alias("any_n")
    )


@query
def agg_having(b):
    groups = b.table("lineitem").groupBy("l_orderkey", "l_linenumber")
    return groups.agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


@query
def agg_rollup_hierarchy(b):
    return ms.measure(
        b.overview(started=False),
        b.overview(started=False),
        ["vehicles"],
        by=("brand", "model"),
        rollup=True,
    )


@query
def agg_group_as_distinct(b):
    return b.table("lineitem").select("l_returnflag", "l_linestatus").distinct()


# === sorts, limits and set operations ============================================


@query
def sort_multi_key(b):
    groups = reports.vehicles_by(b.overview(False, False), "registration_year", "vehicle_type")
    return groups.orderBy(
        F.col("registration_year").desc(), F.col("vehicles").desc(), "vehicle_type"
    )


@query
def topk_rows(b):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return topn.top_rows(b.table("orders").select("o_orderkey", "o_totalprice"), order, 50)


@query
def topn_with_ties(b):
    """Customers among the ten largest order counts; ties at the boundary stay."""
    groups = b.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return topn.topn_with_ties(groups, "n", 10)


@query
def distinct_rows(b):
    return b.fuels(lineage=False).select(
        "fuel_type", "emission_code", "hybrid_class"
    ).distinct()


@query
def union_all(b):
    a = b.table("orders").select(F.col("o_orderkey").alias("key"), F.lit("order").alias("kind"))
    c = b.table("lineitem").select(F.col("l_orderkey").alias("key"), F.lit("line").alias("kind"))
    return a.unionByName(c)


@query
def except_all_both_ways(b):
    """Multiset difference between all line keys and de-duplicated line keys."""
    cols = ["l_orderkey", "l_linenumber"]
    return quality.multiset_diff(b.table("lineitem").select(*cols), b.lines().select(*cols))


@query
def except_all_by_bucket(b):
    """The same difference, found through checksums of buckets."""
    cols = ["l_orderkey", "l_linenumber"]
    return quality.bucketed_diff(b.table("lineitem").select(*cols), b.lines().select(*cols))


@query
def intersect_ids(b):
    orders = b.table("orders").select(F.col("o_orderkey").alias("key"))
    return orders.intersect(b.table("lineitem").select(F.col("l_orderkey").alias("key")))


@query
def set_difference(b):
    orders = b.table("orders").select(F.col("o_orderkey").alias("key"))
    return orders.subtract(b.table("lineitem").select(F.col("l_orderkey").alias("key")))


# === scalar functions ============================================================


@query
def scalar_text(b):
    name = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))
    return b.table("customer").select(
        "c_custkey",
        F.lower("c_mktsegment").alias("lowered"),
        F.upper("c_name").alias("uppered"),
        F.trim(name).alias("trimmed"),
        F.length(name).alias("len"),
        text.blank_to_null(F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(name)).alias(
            "blank_to_null"
        ),
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("-")).alias(
            "coalesced"
        ),
        F.concat(
            F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.lit("!"))
        ).alias("null_concat"),
        (~F.col("c_mktsegment").rlike("^[A-F]")).alias("not_matching"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("listed"),
    )


@query
def scalar_dates(b):
    day = F.to_date("o_orderdate")
    return b.table("orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").alias("compact"),
        *calendar_parts(day),
        F.add_months(day, 12).alias("next_year"),
        (day < F.lit("1998-01-01").cast("date")).alias("early"),
    )


@query
def scalar_numbers(b):
    balance = F.col("c_acctbal")
    return b.table("customer").select(
        "c_custkey",
        text.round_half_away(balance / 7, 2).alias("rounded"),
        F.try_divide(balance, F.nullif(F.col("c_nationkey"), F.lit(0))).alias("divided"),
        F.when(balance > 0, "credit").alias("side"),
        F.greatest(F.lit(0.0), balance).alias("floored"),
    )


# === normalisation ===============================================================


@query
def normalize_vehicles(b):
    return normalize.normalize_vehicles(b.raw_vehicles(), SPEC, "run_x")


@query
def normalize_fuels(b):
    return normalize.normalize_fuels(b.raw_fuels(), SPEC, "run_x")


@query
def salted_sha256(b):
    key = F.col("o_orderkey").cast("string")
    return b.table("orders").select(
        "o_orderkey", keys.salted_sha256(key, SALT).alias("vehicle_id_hash")
    )


@query
def drop_blank_id(b):
    return normalize.drop_blank_id(b.raw_fuels(), ID).select(
        text.strip(F.col(ID)).alias("id"), "brandstof_volgnummer"
    )


def _parsed(b, *cols):
    return b.raw_fuels().select(*[c.alias(f"c{i}") for i, c in enumerate(cols)])


@query
def clean_upper(b):
    return b.raw_vehicles().select(
        text.clean_upper(F.col("merk")).alias("brand"),
        text.clean_upper(F.col("handelsbenaming")).alias("model"),
    )


@query
def clean_text(b):
    return _parsed(
        b,
        text.clean_text(F.col("emissiecode_omschrijving")),
        text.clean_text(F.col("brandstof_omschrijving")),
    )


@query
def default_text(b):
    return _parsed(b, text.default_text(F.col("brandstof_omschrijving"), "Unknown"))


@query
def parse_compact_date(b):
    return b.raw_vehicles(attributes=False).select(
        text.strip(F.col(ID)).alias("id"),
        text.parse_compact_date(F.col("datum_eerste_toelating")).alias("registration_date"),
    )


@query
def parse_decimal_comma(b):
    return _parsed(
        b,
        text.parse_decimal_comma(F.col("co2_uitstoot_gecombineerd")),
        text.parse_decimal_comma(F.col("nettomaximumvermogen")),
    )


@query
def parse_int_default(b):
    return _parsed(b, text.parse_int_default(F.col("brandstof_volgnummer")))


@query
def derive_year(b):
    day = text.parse_compact_date(F.col("datum_eerste_toelating"))
    return b.raw_vehicles(attributes=False).select(
        text.strip(F.col(ID)).alias("id"), F.year(day).alias("registration_year")
    )


@query
def stamp_lineage(b):
    run = normalize.stamp_lineage(run_of(F.col("o_orderdate")))
    return b.table("orders").select("o_orderkey", run.alias("ingestion_id"))


# === upsert and staging ==========================================================


def _earlier(b):
    """An older state of staging: other types, and vehicles that return later."""
    return b.vehicles(attributes=False).withColumn("vehicle_type", F.lit("old"))


@query
def upsert_by_key_one(b):
    """Replace the vehicles that have a profile."""
    target = _earlier(b).select("vehicle_id_hash", "vehicle_type", "ingestion_id")
    incoming = b.wide(False, False).select("vehicle_id_hash", "vehicle_type", "ingestion_id")
    return upsert.upsert_by_key(target, incoming, ["vehicle_id_hash"])


@query
def upsert_by_key_two(b):
    """Target keyed once per line; incoming keeps its repeated lines."""
    cols = ["l_orderkey", "l_linenumber", "l_returnflag"]
    target = b.lines().select(*cols)
    incoming = b.table("lineitem").where(F.col("l_returnflag") == "R").select(*cols)
    return upsert.upsert_by_key(target, incoming, ["l_orderkey", "l_linenumber"])


def _bucketed(b):
    """Lines stored in buckets, then upserted with those of one order key in a thousand."""
    path, columns = scratch_path(b.spark, "buckets"), ["l_orderkey", "l_linenumber", "l_returnflag"]
    keys_ = ["l_orderkey", "l_linenumber"]
    target = b.lines().select(*columns)
    buckets.write_buckets(target, path, keys_)
    files = F.struct("_metadata.file_path", "_metadata.file_modification_time")
    stored = b.spark.read.parquet(path)
    before = materialize(stored.select(buckets.BUCKET, files.alias("file")).distinct(), "files")
    incoming = b.table("lineitem").where("l_orderkey % 1000 = 0")
    incoming = incoming.select("l_orderkey", "l_linenumber", F.lit("U").alias("l_returnflag"))
    touched = buckets.upsert_buckets(incoming, path, target.schema, keys_)
    now = b.spark.read.parquet(path).select(buckets.BUCKET, files.alias("file")).distinct()
    rows = buckets.read_buckets(b.spark, path, target.schema).select(*columns)
    return rows, before.where(~F.col(buckets.BUCKET).isin(touched)), now


@query
def upsert_buckets(b):
    """The table after an upsert that rewrote only the buckets of its keys."""
    return _bucketed(b)[0]


@query
def upsert_buckets_untouched(b):
    """Files of buckets without an incoming key that the upsert has changed, and whether there are any."""
    _, before, now = _bucketed(b)
    gone = before.join(now, [buckets.BUCKET, "file"], "left_anti")
    return _rows(gone, "changed").withColumn("some_untouched", F.lit(not before.isEmpty()))


@query
def resolve_latest(b):
    """Line items as a log of upserts, one version per ship year."""
    log = b.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("version")
    )
    return upsert.resolve_latest(log, ["l_orderkey", "l_linenumber"], "version")


@query
def upsert_empty_guard(b):
    """Passes through when rows are left, raises otherwise."""
    rows = normalize.normalize_vehicles(b.raw_vehicles(), SPEC, "run_x")
    return _rows(upsert.require_rows(rows, "no vehicle row is left"))


def _staged(b):
    return {k: v for k, v in b.staging().items() if k != "ingestion_runs"}


@query
def page_transaction(b):
    """Vehicles and fuels committed as one set, read back through one pointer."""
    root = scratch_path(b.spark, "staging")
    publication.publish_set(_staged(b), root, ("fuels", "vehicles"))
    committed = {n: publication.scan_published(b.spark, root, n) for n in ("fuels", "vehicles")}
    return tables.output_inventory(committed, ("fuels", "vehicles"))


@query
def replace_snapshot(b):
    """A smaller snapshot replaces a larger one whole."""
    root = scratch_path(b.spark, "staging")
    vehicles = b.vehicles(attributes=False)
    publication.publish_set({"vehicles": vehicles}, root, ("vehicles",))
    smaller = vehicles.where(F.col("vehicle_type") == "F")
    publication.publish_set({"vehicles": smaller}, root, ("vehicles",))
    return publication.scan_published(b.spark, root, "vehicles")


@query
def schema_gate(b):
    """Problems per staging table, with the rows that the gate would let through."""
    staging = {**_staged(b), "broken": b.table("lineitem")}
    problems = {
        "vehicles": gates.schema_problems({"vehicles": staging["vehicles"]}, _only("vehicles")),
        "fuels": gates.schema_problems({"fuels": staging["fuels"]}, _only("fuels")),
        "broken": gates.schema_problems({"fuels": staging["broken"]}, _only("fuels")),
    }
    parts = [
        _rows(staging[name]).select(
            F.lit(name).alias("relation"), F.lit(len(found)).alias("problems"), "rows"
        )
        for name, found in problems.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _only(table):
    return {table: gates.REQUIRED_STAGING[table]}


# === page assembly ===============================================================


def _raw_anchors(b):
    return b.lines().select(F.col("l_orderkey").cast("string").alias(ID), fuel_name().alias("f"))


@query
def keyset_page(b):
    return paging.keyset_page(
        _raw_anchors(b), ID, "f", SPEC.wanted_types, after="5", limit=DEFAULT_PAGE_SIZE
    )


def _anchor_pages(b):
    ids = paging.anchor_ids(_raw_anchors(b), ID, "f", SPEC.wanted_types)
    return paging.number_pages(ids, ID, DEFAULT_PAGE_SIZE)


@query
def keyset_page_all(b):
    return _anchor_pages(b)


@query
def batch_assign(b):
    ids = b.raw_fuels().select(text.strip(F.col(ID)).alias(ID))
    return paging.batch_assign(ids, ID, DEFAULT_DETAIL_BATCH)


@query
def detail_lookup(b):
    """Detail rows of the first page of identifiers."""
    details = b.lines().select(
        F.col("l_orderkey").cast("string").alias(ID), "l_linenumber", "l_returnflag"
    )
    page = paging.keyset_page(_raw_anchors(b), ID, "f", SPEC.wanted_types)
    return matching.detail_lookup(details, page, ID)


@query
def offset_page(b):
    orders = b.table("orders").select("o_orderkey", "o_orderdate")
    return paging.offset_page(orders, [F.col("o_orderdate"), F.col("o_orderkey")], 500, 200)


@query
def offset_page_deep(b):
    """A page further down the order, with ties in the leading column."""
    lines = b.lines().select("l_orderkey", "l_linenumber", "l_shipdate")
    return paging.offset_page(lines, [F.col("l_shipdate")], 3_000, 1_000)


@query
def snapshot_cap(b):
    accepted = b.profile().select(F.col("vehicle_id_hash"))
    return paging.snapshot_cap(accepted, "vehicle_id_hash", DEFAULT_SNAPSHOT_LIMIT)


@query
def page_order_guard(b):
    """Order keys taken as text in numeric order: the digit rollovers break the order.

    Every seventh page is missing; the page behind the gap is compared with the one before.
    """
    key = F.col("o_orderkey")
    pages = b.table("orders").select(
        F.floor(key / 1000).alias("page"), (key % 1000).alias("pos"), key.cast("string").alias(ID)
    )
    return paging.page_order_guard(pages.where(F.col("page") % 7 != 3), ID)


@query
def page_order_guard_clean(b):
    """Pages of the keyset sweep satisfy the guard."""
    return paging.page_order_guard(_anchor_pages(b), ID)


def _datasets(b):
    """Anchors with pages, and detail datasets that each miss some identifiers."""
    anchors = b.table("orders").select(
        F.floor(F.col("o_orderkey") / 1000).alias("page"),
        F.when(F.col("o_orderkey") % 40 == 0, " ")
        .otherwise(F.col("o_orderkey").cast("string"))
        .alias(ID),
    )
    vehicles = b.raw_vehicles(attributes=False).select(ID)
    fuels = b.raw_fuels().select(ID)
    return anchors, vehicles, fuels


@query
def complete_ids(b):
    return matching.complete_ids(*_datasets(b), ID)


@query
def complete_rows(b):
    anchors, vehicles, fuels = _datasets(b)
    complete = matching.complete_ids(anchors, vehicles, fuels, ID)
    details = b.raw_fuels().select(ID, "brandstof_volgnummer")
    return matching.complete_rows(details, complete, ID)


@query
def page_counters(b):
    counters = matching.page_counters(*_datasets(b), ID).withColumn("run", F.lit("r"))
    return matching.cumulative_counters(
        counters, "run", "page", ["source_rows", "matched", "fuel_rows", "rejected"]
    )


@query
def rejection_count(b):
    return matching.page_counters(*_datasets(b), ID).agg(
        F.sum("rejected").alias("rejected_rows"), F.sum("matched").alias("matched_vehicles")
    )


# --- payloads --------------------------------------------------------------------


def _order_pages(b):
    fields = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    ids = b.table("orders").select(*[F.col(c).cast("string").alias(c) for c in fields])
    placed = paging.global_position(ids, F.col("o_orderkey"))
    return placed.select(
        F.lit("orders").alias("dataset"),
        F.floor(F.col("position") / DEFAULT_PAGE_SIZE).alias("page"),
        (F.col("position") % DEFAULT_PAGE_SIZE).alias("pos"),
        *fields,
    ), fields


@query
def page_digest(b):
    rows, fields = _order_pages(b)
    return payloads.page_digest(rows, ["dataset", "page"], "pos", fields).drop("payload")


def _payload_pages(b):
    rows, fields = _order_pages(b)
    pages = payloads.page_digest(rows, ["dataset", "page"], "pos", fields)
    return materialize(pages.withColumn("chunk", F.lit(0)), "payloads"), fields


@query
def land_raw_page(b):
    """What the manifest says after landing every page."""
    pages, _ = _payload_pages(b)
    root = scratch_path(b.spark, "raw")
    raw.land_raw_pages(pages, root, "run_1")
    return raw.read_manifest(b.spark, root, "run_1").select(
        "dataset", "page", F.col("payload_sha256").alias("digest"), "duplicate"
    )


@query
def raw_integrity_scan(b):
    """The last byte of the first page's payload is damaged: it is found, and then missing."""
    pages, _ = _payload_pages(b)
    damaged = F.concat(F.expr("substring(payload, 1, length(payload) - 1)"), F.lit("}"))
    body = F.when(F.col("page") == 0, damaged).otherwise(F.col("payload"))
    root = scratch_path(b.spark, "raw")
    raw.land_raw_pages(pages.withColumn("payload", body), root, "run_1")
    scan = raw.raw_integrity_scan(b.spark, root)
    lost = raw.missing_pages(scan, pages.select("payload_sha256"))
    return scan.select("digest", "ok").unionByName(
        lost.select(F.col("payload_sha256").alias("digest"), F.lit(False).alias("ok"))
    )


@query
def scan_raw_json(b):
    """Page payloads in text files, one page a line."""
    pages, fields = _payload_pages(b)
    root = scratch_path(b.spark, "files")
    pages.select("payload").write.text(root)
    return raw.scan_raw_json(b.spark, root, fields, wholetext=False).drop("file")


@query
def scan_raw_pages(b):
    """Rows of a run, found through its manifest, part of them stored by an earlier run."""
    pages, fields = _payload_pages(b)
    root = scratch_path(b.spark, "raw")
    raw.land_raw_pages(pages.where("page % 2 = 0"), root, "run_1")
    raw.land_raw_pages(pages, root, "run_2")
    return raw.scan_pages(b.spark, root, "run_2", "orders", fields).drop("chunk")


def _arrivals(b):
    """Documents as arriving payloads: a text seen before is a duplicate payload."""
    return b.table("documents").select(
        F.col("lang").alias("dataset"),
        F.sha2("text", 256).alias("payload_sha256"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("raw_path"),
        F.col("n_chars").alias("row_count"),
        F.concat(F.lit("run_"), F.col("source")).alias("first_ingestion_id"),
        "doc_id",
    )


def _ledger(b):
    """What a first source left in the ledger."""
    known = b.table("documents").where(F.col("source") == "src0")
    return known.groupBy(
        F.col("lang").alias("dataset"), F.sha2("text", 256).alias("payload_sha256")
    ).agg(
        F.lit("known").alias("raw_path"),
        F.max("n_chars").alias("row_count"),
        F.lit("run_0").alias("first_ingestion_id"),
    )


@query
def payload_ledger_insert(b):
    _, flagged = payloads.ledger_insert(_ledger(b), _arrivals(b), ["doc_id"])
    return flagged.select("doc_id", "dataset", "payload_sha256", "duplicate")


@query
def payload_ledger_table(b):
    ledger, _ = payloads.ledger_insert(_ledger(b), _arrivals(b), ["doc_id"])
    return ledger


@query
def duplicate_payload_count(b):
    _, flagged = payloads.ledger_insert(_ledger(b), _arrivals(b), ["doc_id"])
    return payloads.duplicate_payload_count(flagged, "first_ingestion_id")


@query
def resume_cursor(b):
    """Page 5 was not committed, and the payload of page 9 has changed since."""
    pages = _anchor_pages(b)
    digest = F.md5(F.col("page").cast("string"))
    commits = pages.select("page").distinct().select(
        "page",
        (F.col("page") != 5).alias("committed"),
        digest.alias("digest"),
        F.when(F.col("page") == 9, "other").otherwise(digest).alias("landed_digest"),
    )
    return paging.resume_cursor(pages, commits, ID)


# --- runs ------------------------------------------------------------------------


@query
def run_metrics(b):
    return run_ops.run_metrics(b.runs())


@query
def run_upsert(b):
    """Resumed runs are updated twice, the later update coming first, and each starts a new run."""
    runs = b.runs()
    changed = runs.where("resumed")
    updates = [
        changed.withColumn("status", F.lit(status)).withColumn("sequence", F.lit(n))
        for n, status in ((2, "interrupted"), (1, "running"))
    ]
    new = updates[1].withColumn("ingestion_id", F.concat(F.lit("new_"), F.col("ingestion_id")))
    all_ = reduce(DataFrame.unionByName, [*updates, new])
    return run_ops.run_upsert(runs, all_).select("ingestion_id", "status", "vehicle_rows")


@query
def run_schema_evolve(b):
    """Runs of early layouts, brought to the current one; those of odd years already hold
    some of its values."""
    odd = F.substring("ingestion_id", -4, 4).cast("int") % 2 == 1
    old = b.runs().select(
        "ingestion_id",
        "started_at",
        "status",
        "sample_limit",
        "vehicle_rows",
        F.col("active_duration_seconds").alias("run_duration_seconds"),
        F.when(odd, 1.5).otherwise(0.0).alias("active_duration_seconds"),
        F.col("processed_rows_per_second").alias("rows_per_second"),
        F.when(odd, "completed").alias("checkpoint_status"),
        F.lit("resumable_snapshot").alias("ingestion_mode"),
    )
    return run_ops.evolve_runs(old).select(
        "ingestion_id",
        "ingestion_mode",
        "requested_limit",
        "active_duration_seconds",
        "processed_rows_per_second",
        "resumed",
        "resume_count",
        "matched_vehicles",
    )


# === sources and sinks ===========================================================


@query
def scan_staging(b):
    root = scratch_path(b.spark, "staging")
    tables.write_staging(b.staging(), root)
    return tables.output_inventory(
        tables.scan_staging(b.spark, root), tuple(tables.STAGING_TABLES)
    )


@query
def projected_source_scan(b):
    return raw.projected_source_scan(b.table("lineitem"), ["l_orderkey", "l_returnflag"])


@query
def filtered_source_scan(b):
    rows = b.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return raw.filtered_source_scan(rows, "l_orderkey", {"l_returnflag": ["A", "N"]}, after=1000)


@query
def catalog_scan(b):
    """Columns of the staging tables, with type and the number of values each holds."""
    found = {"vehicles": b.vehicles(), "fuels": b.fuels()}
    parts = []
    for name, df in found.items():
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        cells = F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in df.columns]
        )
        parts.append(
            counts.select(F.lit(name).alias("relation"), F.explode(cells).alias("x")).select(
                "relation", "x.column_name", "x.n"
            )
        )
    filled = reduce(DataFrame.unionByName, parts)
    return tables.catalog_scan(b.spark, found).join(filled, ["relation", "column_name"])


@query
def write_zstd_parquet(b):
    """The metrics mart, written and read back."""
    root = scratch_path(b.spark, "relation")
    path = publication.write_zstd_parquet(b.metrics(), root, "mart_ev_metrics")
    return b.spark.read.parquet(path)


@query
def describe_parquet(b):
    """Columns of the published metrics file, each with its number of values."""
    root = scratch_path(b.spark, "relation")
    path = publication.write_zstd_parquet(b.metrics(), root, "mart_ev_metrics")
    columns = tables.describe_parquet(b.spark, path)
    df = b.spark.read.parquet(path)
    counts = df.agg(*[F.count(c).alias(c) for c in columns])
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns]
    )
    return counts.select(F.explode(cells).alias("x")).select("x.column_name", "x.n")


@query
def publish_set(b):
    """Staging to a published set, and its inventory."""
    return tables.output_inventory(b.published(), PUBLISHED_RELATIONS)


@query
def scan_published_parquet(b):
    root = scratch_path(b.spark, "published")
    publication.publish_set({"mart_ev_overview": b.overview()}, root, ("mart_ev_overview",))
    return publication.scan_published(b.spark, root, "mart_ev_overview")


@query
def output_inventory(b):
    return tables.output_inventory(b.stored_models(), PUBLISHED_RELATIONS)


# === streaming ===================================================================


def _pages(b):
    """Payloads of the whole sweep, as its pages would arrive."""
    b.share_raw_lines()
    ids = paging.anchor_ids(_raw_anchors(b), ID, "f", SPEC.wanted_types)
    pages = ingestion.cut_pages(ids, b.raw_vehicles(), b.raw_fuels(), SPEC, DEFAULT_PAGE_SIZE)
    return materialize(pages, "pages", raw.PAYLOADS_PER_FILE)


def _ingested(b, pages, root, run, pages_per_file=raw.PAGES_PER_FILE):
    """What the stream makes of the pages of a run."""
    log = scratch_path(b.spark, "log")
    raw.land_raw_pages(pages, root, run, pages_per_file=pages_per_file)
    ingest.stream_page_ingest(b.spark, root, log, SPEC, run).awaitTermination()
    return ingest.settle(b.spark, log)


@query
def stream_page_ingest(b):
    """Staged fuels after streaming every landed page."""
    return _ingested(b, _pages(b), scratch_path(b.spark, "raw"), "run_x")["fuels"]


@query
def stream_bounded_page(b):
    """Staged vehicles; the same pages in smaller micro-batches give the same rows."""
    return _ingested(b, _pages(b), scratch_path(b.spark, "raw"), "run_x", 25)["vehicles"]


@query
def stream_second_snapshot(b):
    """A smaller snapshot, part of it unchanged and part new, after a larger one: staged
    vehicles are those of the smaller one alone."""
    root, pages = scratch_path(b.spark, "raw"), _pages(b)
    _ingested(b, pages, root, "run_w")
    return _ingested(b, pages.where("page = 0"), root, "run_x")["vehicles"]


@query
def stream_rerun(b):
    """The same pages in a second run: the same rows, and every payload a duplicate."""
    root, pages = scratch_path(b.spark, "raw"), _pages(b)
    _ingested(b, pages, root, "run_w")
    again = _ingested(b, pages, root, "run_x")
    named = raw.read_manifest(b.spark, root, "run_x")
    counted = {
        **again,
        "new_payloads": raw.payload_ledger(b.spark, root).where("stored_in = 'run_x'"),
        "pages_not_duplicate": named.where(~F.col("duplicate")),
    }
    return tables.output_inventory(counted, tuple(counted))


def _clean_raw(b):
    """Raw rows without defects: what they publish can be computed from the tables."""
    key = F.col("l_orderkey").cast("string").alias(ID)
    fuels = b.lines().select(
        key,
        F.col("l_linenumber").cast("string").alias("brandstof_volgnummer"),
        fuel_name().alias("brandstof_omschrijving"),
        F.lit(None).cast("string").alias("emissiecode_omschrijving"),
        F.col("l_quantity").cast("int").cast("string").alias("co2_uitstoot_gecombineerd"),
        F.lit(None).cast("string").alias("nettomaximumvermogen"),
        F.lit(None).cast("string").alias("klasse_hybride_elektrisch_voertuig"),
    )
    day = F.date_format("o_orderdate", "yyyyMMdd")
    vehicles = b.orders(attributes=True).select(
        F.col("o_orderkey").cast("string").alias(ID),
        F.col("n_name").alias("merk"),
        F.col("c_mktsegment").alias("handelsbenaming"),
        day.alias("datum_eerste_toelating"),
        F.col("o_orderpriority").alias("eerste_kleur"),
        F.lit(None).cast("string").alias("tweede_kleur"),
        F.col("o_orderstatus").alias("voertuigsoort"),
    )
    return vehicles, fuels


@query
def stream_page_counters(b):
    """Counters of every anchor page as the micro-batches left them."""
    root, log = scratch_path(b.spark, "raw"), scratch_path(b.spark, "log")
    raw.land_raw_pages(_pages(b), root, "run_x", pages_per_file=25)
    ingest.stream_page_ingest(b.spark, root, log, SPEC, "run_x", blocks_per_batch=2).awaitTermination()
    return ingest.counted_pages(b.spark, log)


def _job_pages(b):
    b.share_raw_lines()
    vehicles, fuels = _clean_raw(b)
    ids = paging.anchor_ids(_raw_anchors(b), ID, "f", SPEC.wanted_types)
    return ingestion.cut_pages(ids, vehicles, fuels, SPEC, DEFAULT_PAGE_SIZE)


def _job_outcome(b, root, result, counters):
    """Counters of the run row and rows of what was published."""
    runs = ingestion.read_runs(b.spark, ingestion.Folders(root)).where("status = 'succeeded'")
    cells = [F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("rows")) for c in counters]
    facts = ("dim_vehicle", "fact_vehicle_snapshot", "fact_vehicle_fuel", "mart_ev_overview")
    published = b.spark.createDataFrame(
        [(name, result.relation_rows[name]) for name in facts], "name string, rows bigint"
    )
    return runs.select(F.explode(F.array(*cells)).alias("c")).select("c.*").unionByName(published)


JOB_COUNTERS = ["matched_vehicles", "fuel_rows", "source_rows_received", "rejected_rows"]


@query
def snapshot_job(b):
    """One whole run: counters of its run row and rows of what it published."""
    root = scratch_path(b.spark, "warehouse")
    result = ingestion.snapshot_job(b.spark, _job_pages(b), root, SPEC, "run_1")
    return _job_outcome(b, root, result, JOB_COUNTERS)


@query
def snapshot_job_resumed(b):
    """A run that failed for want of fuel pages and was resumed with all pages."""
    root = scratch_path(b.spark, "warehouse")
    pages = materialize(_job_pages(b), "pages", raw.PAYLOADS_PER_FILE)
    try:
        ingestion.snapshot_job(b.spark, pages.where("dataset <> 'fuels'"), root, SPEC, "run_1")
    except upsert.EmptySnapshotError:
        pass
    result = ingestion.snapshot_job(b.spark, pages, root, SPEC, "run_1")
    return _job_outcome(b, root, result, [*JOB_COUNTERS, "resume_count"])


@query
def snapshot_job_limit(b):
    """Staged vehicles of a run with a limit: the first complete ones in the order of the pages."""
    root = scratch_path(b.spark, "warehouse")
    ingestion.snapshot_job(b.spark, _job_pages(b), root, SPEC, "run_1", limit=500)
    staged = publication.scan_published(b.spark, ingestion.Folders(root).staging, "vehicles")
    return staged.select("vehicle_id_hash")


@query
def run_cursor(b):
    """Where a run goes on of which half of the pages have landed."""
    root = scratch_path(b.spark, "warehouse")
    pages = materialize(_job_pages(b), "pages", raw.PAYLOADS_PER_FILE)
    half = pages.agg(F.floor((F.max("page") + 1) / 2)).first()[0]
    raw.land_raw_pages(pages.where(F.col("page") < half), ingestion.Folders(root).raw, "run_1")
    cursor = ingestion.run_cursor(b.spark, root, SPEC, "run_1")
    return b.spark.createDataFrame([(cursor,)], "cursor string")


@query
def verify_run(b):
    """Payloads of a second run that a check finds damaged: it reads what no check has read, the
    first run's unchecked partitions among it."""
    pages, _ = _payload_pages(b)
    root = scratch_path(b.spark, "raw")
    damaged = F.when(F.col("page") == 2, F.concat("payload", F.lit(" "))).otherwise(F.col("payload"))
    raw.land_raw_pages(pages.where("page < 2"), root, "run_0")
    raw.verify_run(b.spark, root, "run_0")
    raw.land_raw_pages(pages.where("page < 4").withColumn("payload", damaged), root, "run_1")
    raw.land_raw_pages(pages, root, "run_2")
    return raw.verify_run(b.spark, root, "run_2").withColumnRenamed("payload_sha256", "digest")
