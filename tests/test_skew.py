"""One key holds at least a third of all rows; results must stay whole."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from snapharbor.operators import joins, matching, payloads, quality, upsert
from snapharbor.plans import models as m

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    return spark.range(N).select(key.alias("vehicle_id_hash"), F.col("id").alias("n")).cache()


@pytest.fixture
def small_skew(spark):
    """Make AQE treat test-sized partitions as skewed, and join by sorting."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_hot_vehicle_is_split_in_the_fact_join(spark, spec, hot, small_skew):
    run = F.concat(F.lit("r"), F.length("vehicle_id_hash"))
    fuels = hot.repartition(8).select(
        "vehicle_id_hash",
        F.col("n").cast("int").alias("fuel_sequence"),
        F.lit("Elektriciteit").alias("fuel_type"),
        F.lit(None).cast("string").alias("emission_code"),
        F.lit(1.0).alias("co2_combined_g_km"),
        F.lit(None).cast("double").alias("net_max_power_kw"),
        F.lit(None).cast("string").alias("hybrid_class"),
        run.alias("ingestion_id"),
    )
    profile = m.type_profile(fuels, spec)
    parents = profile.select(
        F.col("vehicle_id_hash").alias("vehicle_key"),
        run.alias("snapshot_ingestion_id"),
        F.lit("s").alias("vehicle_snapshot_key"),
    )
    fact = m.fact_vehicle_fuel(m.fuel_parents(fuels, parents), spec)
    rows = fact.groupBy(F.col("vehicle_key") == "hot").count()
    assert values(rows) == [(False, N - N // 3), (True, N // 3)]
    fact.write.format("noop").mode("overwrite").save()
    joined = fact.select("vehicle_key", "fuel_sequence")
    joined.collect()
    assert "skew=true" in final_plan(joined)


@pytest.mark.parametrize("name", ["keep", "drop", "latest", "ledger"])
def test_hot_rows_are_split_when_joined_with_reduced_keys(hot, small_skew, name):
    rows = hot.repartition(8)
    if name == "keep":
        got = joins.keep_ids(rows, hot, "vehicle_id_hash")
    elif name == "drop":
        got = joins.drop_ids(rows, hot.where("vehicle_id_hash like 'k1%'"), "vehicle_id_hash")
    elif name == "latest":
        got = upsert.resolve_latest(rows.withColumn("v", F.lit(1) + F.col("n") * 0), ["vehicle_id_hash"], "v")
    else:
        frame = rows.select(
            F.lit("d").alias("dataset"), F.col("vehicle_id_hash").alias("payload_sha256"), "n"
        )
        ledger = frame.where("n < 10")
        got = payloads.ledger_insert(ledger, frame, ["n"])[1]
    kept = {"keep": N, "drop": N - hot.where("vehicle_id_hash like 'k1%'").count()}.get(name, N)
    assert len(got.collect()) == kept
    assert "skew=true" in final_plan(got)


def test_keys_are_reduced_before_they_meet(hot):
    other = hot.select("vehicle_id_hash").union(hot.select("vehicle_id_hash"))
    assert joins.keep_ids(hot, other, "vehicle_id_hash").count() == N
    assert joins.drop_ids(hot, other, "vehicle_id_hash").count() == 0
    found = quality.dq_relationship(hot, "vehicle_id_hash", hot.where("n > 0"), "vehicle_id_hash")
    assert found.count() == 0
    gone = quality.dq_relationship(
        hot, "vehicle_id_hash", hot.where("vehicle_id_hash != 'hot'"), "vehicle_id_hash"
    )
    assert values(gone) == [("hot", N // 3)]


def test_keep_last_limits_before_the_shuffle(hot):
    last = upsert.keep_last(hot, ["vehicle_id_hash"], [F.col("n")])
    assert last.count() == N - N // 3 + 1
    assert last.where("vehicle_id_hash = 'hot'").first()["n"] == N - 3
    plan = last._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange


def test_hot_batch_becomes_many_pages(hot):
    rows = hot.withColumn("batch", F.when(F.col("vehicle_id_hash") == "hot", 0).otherwise(1))
    cut = payloads.detail_pages(rows, "batch", ["vehicle_id_hash"], 1000)
    sizes = cut.groupBy("batch", "chunk").count()
    assert sizes.agg(F.max("count")).first()[0] == 1000
    assert cut.select("n").distinct().count() == N


def test_counters_with_a_hot_identifier(spark, hot):
    fuels = hot.select(F.col("vehicle_id_hash").alias("id"))
    ids = fuels.distinct()
    anchors = ids.withColumn("page", F.pmod(F.xxhash64("id"), F.lit(7)))
    total = matching.page_counters(anchors, ids, fuels, "id").agg(
        F.sum("fuel_rows"), F.sum("matched"), F.sum("rejected")
    )
    assert tuple(total.first()) == (N, N - N // 3 + 1, 0)


def test_copies_stay_one_row(hot):
    same = hot.select(F.lit("x").alias("v"))
    assert values(quality.multiset_diff(same, same.limit(1))) == [("x", "expected", N - 1)]


def test_stored_lookups_are_broadcast_by_their_size(spark):
    left = spark.range(5).withColumn("a", F.lit(1))
    right = spark.range(3).withColumn("b", F.lit(2))
    joined = joins.lookup_join(left, right, "id", "left")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    want = [(0, 2), (1, 2), (2, 2), (3, None), (4, None)]
    assert values(joined, "id", "b") == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert values(joins.lookup_join(left, right, "id", "left"), "id", "b") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
