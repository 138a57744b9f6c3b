"""What moves and what is stored stays small; results are those of the plain way."""

import glob
import os
from datetime import date
from urllib.parse import urlparse

import pyarrow.parquet as pq
from conftest import values
from pyspark.sql import functions as F

from snapharbor.binding.star import KEY, StarBinding
from snapharbor.functions.keys import packed, unpacked
from snapharbor.operators import matching, paging, quality, upsert
from snapharbor.plans import contracts, ingestion, maintenance
from snapharbor.plans import models as m
from snapharbor.session import ROW_GROUP_BYTES, configure, materialize, stored_meanwhile, stored_writer
from snapharbor.sources import raw as raw_source


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_packed_keys_tell_all_texts_apart(spark):
    sha = "0123456789abcdef" * 4
    texts = [sha, sha.upper(), sha[:32], sha[:31], sha + "\n", "", " ", "x" * 32, "\0" * 16, "\0" * 33, "é", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p"))
    assert [r["t"] for r in df.select(unpacked(F.col("p")).alias("t")).collect()] == texts
    assert df.where("p is not null").select("p").distinct().count() == len(texts) - 1
    assert [len(r["p"]) for r in df.limit(4).collect()] == [32, 97, 16, 64]


def test_stored_steps_are_compressed(spark):
    files = materialize(spark.range(3), "zstd").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_row_groups_of_stored_steps_are_bounded(spark, tmp_path):
    """A task holds a row group while it writes, and fetches one at once when it reads."""
    rows = spark.range(0, 800_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    stored_writer(rows, "overwrite").parquet(str(tmp_path / "log"))
    for files in (materialize(rows, "groups").inputFiles(), spark.read.parquet(str(tmp_path / "log")).inputFiles()):
        found = [pq.ParquetFile(urlparse(f).path).metadata for f in files]
        sizes = [m.row_group(i).column(0).total_compressed_size for m in found for i in range(m.num_row_groups)]
        assert sum(m.num_rows for m in found) == 800_000 and len(sizes) > 1
        assert max(sizes) < 1.1 * ROW_GROUP_BYTES


def test_a_block_is_sorted_by_several_tasks(spark):
    pages = spark.range(600).select((F.col("id") / 2).cast("long").alias("page"))
    found = [(r["page"], r["number"], r["part"]) for r in raw_source.page_slots(pages, 400).orderBy("page").collect()]
    assert found == [(p, 2 * p // 400, 2 * p % 400 // raw_source.PAYLOADS_PER_TASK) for p in range(300)]


def test_files_of_payloads_hold_few_of_them(spark, tmp_path):
    """A reader holds up to 4,096 rows of a file at once, and a payload is a whole page."""
    text = F.concat(F.lit('[{"kenteken":"'), F.col("id").cast("string"), F.lit('"}]'))
    pages = spark.range(150).repartition(1).select(
        F.lit("anchors").alias("dataset"), F.col("id").alias("page"), F.lit(0).alias("chunk"),
        F.sha2(text, 256).alias("payload_sha256"), F.lit(1).alias("row_count"), text.alias("payload"),
    )
    root = str(tmp_path / "raw")
    raw_source.land_raw_pages(pages, root, "run-1")
    stored = raw_source.stored_payloads(spark, root)
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 150 and max(sizes) <= raw_source.PAYLOADS_PER_FILE
    assert len(glob.glob(f"{root}/payloads/*/*")) == 1
    assert raw_source.verify_run(spark, root, "run-1").isEmpty()


def test_a_payload_that_comes_twice_is_stored_once(spark, tmp_path):
    row = "dataset string, page bigint, chunk int, payload_sha256 string, row_count int, payload string"
    rows = [("anchors", 0, None, "a", 0, "[]"), ("anchors", 1, 0, "a", 0, "[]"), ("fuels", 1, None, "b", 0, "[ ]")]
    root = str(tmp_path / "raw")
    raw_source.land_raw_pages(spark.createDataFrame(rows, row), root, "run-1")
    assert values(raw_source.stored_payloads(spark, root), "dataset", "payload_sha256") == [("anchors", "a"), ("fuels", "b")]
    assert values(raw_source.read_manifest(spark, root, "run-1"), "page", "duplicate") == [
        (0, False), (1, False), (1, True)
    ]


def test_a_log_without_repeated_keys_does_not_move(spark):
    rows = [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("b", 1, 2, "z"), (None, 1, 3, "n")]
    log = materialize(spark.createDataFrame(rows, "k string, s int, v int, x string"), "log")
    got = upsert.latest_rows(log, ["k", "s"], "v")
    assert values(got, "x") == [("n",), ("x",), ("y",), ("z",)] and exchanges(got) == 0
    more = log.union(spark.createDataFrame([("a", 1, 5, "w"), ("b", 1, 2, "t"), (None, 1, 4, "m")], log.schema))
    got = upsert.latest_rows(more, ["k", "s"], "v")
    assert values(got) == values(upsert.resolve_latest(more, ["k", "s"], "v").select(*got.columns))
    assert values(got, "x") == [("m",), ("n",), ("t",), ("w",), ("y",), ("z",)]


def test_counters_join_both_datasets_at_once(spark):
    anchors = spark.createDataFrame([(1, "a"), (1, " "), (2, "b"), (2, None)], "page int, id string")
    vehicles = spark.createDataFrame([("a",), ("b",), (" a ",)], "id string")
    fuels = spark.createDataFrame([("a",), (None,)], "id string")
    got = matching.page_counters(anchors, vehicles, fuels, "id")
    assert values(got) == [(1, 5, 2, 1, 1), (2, 3, 0, 0, 2)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


def test_unique_tests_count_exact_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, 2), (None, 3)], "t string, n int")
    tests = {"t": (df, F.col("t")), "n": (df, F.col("n")), "pair": (df, F.concat("t", F.col("n").cast("string")))}
    assert values(quality.run_unique_tests(tests)) == [("n", 1), ("pair", 0), ("t", 1)]
    assert values(quality.run_unique_tests({"pair": tests["pair"]})) == [("pair", 0)]


def test_a_repeated_fuel_row_is_still_found(spark, staging, spec):
    twice = {**staging, "fuels": staging["fuels"].union(staging["fuels"].limit(1))}
    found = dict(values(contracts.contract_checks(m.build_models(twice, spec, write=True)), "check", "violations"))
    assert found["unique:stg_fuels.vehicle_and_sequence"] == 1
    assert found["unique:fact_vehicle_fuel.vehicle_fuel_fact_key"] == 1
    assert sum(found.values()) == 2


def test_changed_vehicles_move_as_checksums(spark):
    columns = ["vehicle", *m.METRIC_KEYS, *maintenance.MEASURES]
    keys = [F.lit(c).alias(c) for c in m.METRIC_KEYS]
    rows = spark.range(60).select((F.col("id") % 20).alias("vehicle"), *keys, F.lit(1.0).alias(columns[-2]), F.lit(None).cast("double").alias(columns[-1]))
    other = rows.where("vehicle <> 3").union(rows.where("vehicle = 5").limit(1)).union(rows.limit(1).withColumn("vehicle", F.lit(99).cast("long")))
    got = maintenance.changed_vehicles(rows, other, "vehicle")
    assert values(got) == [(3,), (5,), (99,)]
    assert values(got) == values(quality.bucketed_diff(rows, other).select("vehicle").distinct())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bucket" in plan and "hashpartitioning(vehicle" not in plan


def test_models_join_by_packed_keys(models):
    plan = m.star_metrics(models)._jdf.queryExecution().analyzed().toString()
    assert "unhex" in plan
    assert values(m.star_metrics(models)) == values(models["mart_ev_metrics"])


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held, before = spark.conf.get(setting), shuffle_files(spark)
    configure(spark, steps=True)
    try:
        counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert materialize(counts, "counts").count() == 7
        assert [counts.count(), len(counts.collect()), len(counts.collect())] == [7, 7, 7]
        assert not shuffle_files(spark) - before
    finally:
        spark.conf.set(setting, held)


def test_a_copy_for_a_block_of_code_is_deleted_behind_it(spark):
    with stored_meanwhile(spark.range(3), "copy") as copy:
        folder = os.path.dirname(copy.inputFiles()[0].removeprefix("file://"))
        assert copy.count() == 3 and glob.glob(f"{folder}/*")
    assert not os.path.exists(folder)


def star(spark, snapshots, fuels):
    """A star whose models, dates and powertrains are those the snapshots name."""
    keys = "vehicle_snapshot_key string, vehicle_key string, vehicle_model_key string"
    fact = spark.createDataFrame(snapshots, f"{keys}, registration_date_key int, powertrain_key string")
    models = spark.createDataFrame([("m1", "A", "x"), ("m2", None, "y")], "vehicle_model_key string, brand string, model string")
    dates = spark.createDataFrame([(1, None, 2020)], "registration_date_key int, registration_date date, registration_year int")
    kinds = spark.createDataFrame([("p", "battery")], "powertrain_key string, powertrain_category string")
    measures = "co2_combined_g_km double, net_max_power_kw double"
    return {
        "fact_vehicle_snapshot": fact, "dim_vehicle_model": models, "dim_registration_date": dates, "dim_powertrain": kinds,
        "fact_vehicle_fuel": spark.createDataFrame(fuels, f"vehicle_snapshot_key string, fuel_type string, {measures}"),
    }


def plain_metrics(star):
    rows = star["fact_vehicle_fuel"].join(star["fact_vehicle_snapshot"], "vehicle_snapshot_key")
    rows = rows.join(star["dim_vehicle_model"], "vehicle_model_key").join(star["dim_powertrain"], "powertrain_key")
    return m.aggregate_metrics(rows.join(star["dim_registration_date"], "registration_date_key", "left"), "vehicle_key")


def test_star_metrics_moves_no_vehicle_keys_to_count_them(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        once = [("s1", "v1", "m1", 1, "p"), ("s2", "v2", "m1", 1, "p"), ("s3", "v3", "m2", None, "p"), ("s4", None, "m2", 1, "p")]
        # v1 in a second snapshot with the same and in a third with other attributes; s2 stands there twice
        twice = [*once, ("s5", "v1", "m1", 1, "p"), ("s6", "v1", "m2", 1, "p"), ("s2", "v2", "m1", 1, "p")]
        fuels = [("s1", "E", 1.0, None), ("s1", "E", 2.0, 3.0), ("s1", "H", None, None), ("s2", "E", 4.0, 5.0), ("s9", "E", 9.0, 9.0)]
        fuels += [(s, "E", 6.0, None) for s in ("s3", "s4", "s5", "s6")] + [("s5", None, 1.0, 1.0), (None, "E", 1.0, 1.0)]
        for snapshots in (once, twice):
            tables = star(spark, snapshots, fuels)
            got, want = m.star_metrics(tables), plain_metrics(tables)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        plan = m.star_metrics(star(spark, once, fuels))._jdf.queryExecution().executedPlan().toString()
        dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
        assert dealt and not any("vehicle_key#" in d for d in dealt)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_only_wanted_line_items_are_hashed_and_no_hash_moves(spark, tmp_path):
    """Line items meet the wanted vehicles by their short key; their hash is taken behind all joins."""
    names = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double"
    names += ", l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
    day = date(1996, 1, 2)
    lines = [(1, 1, "A"), (1, 2, "R"), (2, 1, "R"), (3, 1, "N"), (3, 1, "N"), (None, 1, "A"), (4, 1, "A")]
    rows = [(k, n, 1, 1, 5.0, 9.0, 0.1, 0.0, f, "O", day) for k, n, f in lines]
    orders = [(k, 1, "O", date(1995, 1, 1), "1-URGENT") for k in (1, 2, 3, 3, None)]  # order 4 is unknown
    made = {
        "lineitem": (rows, names),
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate date, o_orderpriority string"),
        "customer": ([(1, 1, "AUTO")], "c_custkey bigint, c_nationkey bigint, c_mktsegment string"),
        "nation": ([(1, "PERU")], "n_nationkey bigint, n_name string"),
    }
    for name, (data, kinds) in made.items():
        spark.createDataFrame(data, kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    binding = StarBinding(spark, str(tmp_path))
    staged = binding.snapshot_staging()["fuels"]
    plan = staged._jdf.queryExecution().optimizedPlan().toString().split("\n")
    hashed = [i for i, line in enumerate(plan) if "sha2(" in line]
    joined = [i for i, line in enumerate(plan) if " Join " in line or line.startswith("Join ")]
    assert len(hashed) == 1 and len(joined) == 2 and hashed[0] < min(joined)  # a plan is read from its end
    every = binding.fuels(keyed=True).where(F.col(KEY).isin(1, 3)).drop(KEY)
    assert values(staged) == values(every)
    assert staged.count() == 4  # two of order 1; order 3 is there twice


def test_anchors_are_not_broadcast_when_pages_are_cut(spark, spec, raw, monkeypatch):
    """However small their files are: ids in order take a byte or two each there, and many more in memory."""
    plans, write = [], paging.materialize

    def noted(df, tag, *more):
        plans.append(df._jdf.queryExecution().optimizedPlan())
        return write(df, tag, *more)

    monkeypatch.setattr(paging, "materialize", noted)
    vehicles, fuels = raw
    anchors = vehicles.select(spec.raw_id).where(F.col(spec.raw_id) != "ODD").distinct()
    pages = ingestion.cut_pages(anchors, vehicles, fuels, spec, 2)
    joins = [p.toString() for p in plans if "Join Inner" in p.toString()]
    assert len(joins) == 2 and all("rightHint=(strategy=merge)" in p for p in joins)
    rows = {r["dataset"]: r["n"] for r in pages.groupBy("dataset").agg(F.sum("row_count").alias("n")).collect()}
    assert rows == {"anchors": 5, "vehicles": 5, "fuels": 8}
