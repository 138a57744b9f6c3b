"""Buckets, checksums of buckets, and the mart that is kept up to date."""

from __future__ import annotations

import os

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapharbor.operators import buckets, quality, upsert
from snapharbor.plans import maintenance
from snapharbor.plans.models import METRIC_KEYS, aggregate_metrics
from snapharbor.session import materialize


def files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k bigint, seq int, v string"
    rows = [(i, s, f"v{i}") for i in range(200) for s in (1, 2)] + [(None, 1, "null key"), (7, None, "null part")]
    target = spark.createDataFrame(rows, schema)
    buckets.write_buckets(target, path, ["k", "seq"], 64)
    before = files(path)
    # another type of the key, a new key, a repeated key, a null key
    incoming = spark.createDataFrame([(3, 1, "new"), (3, 1, "twice"), (999, 1, "fresh"), (None, 1, "more")], "k int, seq bigint, v string")
    touched = buckets.upsert_buckets(incoming, path, target.schema, ["k", "seq"], 64)
    after = files(path)
    same = {f for f in before if int(f.split(f"{buckets.BUCKET}=")[1].split("/")[0]) not in touched}
    assert 1 <= len(touched) <= 3 and same and all(after.get(f) == before[f] for f in same)
    got = buckets.read_buckets(spark, path, target.schema).drop(buckets.BUCKET)
    want = upsert.upsert_by_key(target, incoming.select(*[F.col(f.name).cast(f.dataType) for f in target.schema]), ["k", "seq"])
    assert values(got) == values(want)
    last = spark.createDataFrame([(3, 1, "a", 1), (3, 1, "b", 2)], "k bigint, seq int, v string, n int")
    buckets.upsert_buckets(last, path, target.schema, ["k", "seq"], 64, "last", [F.col("n")])
    got = buckets.read_buckets(spark, path, target.schema)
    assert values(got.where("k = 3 and seq = 1"), "v") == [("b",)] and got.count() == 404
    assert buckets.upsert_buckets(incoming.limit(0), path, target.schema, ["k", "seq"], 64) == []
    assert buckets.read_buckets(spark, path, target.schema, touched[:1]).select(buckets.BUCKET).distinct().count() == 1


def test_checksums_find_what_differs(spark):
    schema = "a int, b string"
    left = spark.createDataFrame([(i % 50, f"x{i % 7}") for i in range(600)] + [(None, None), (None, None)], schema)
    right = left.where("not (a = 3 and b = 'x1')").unionByName(spark.createDataFrame([(1, "only"), (None, None)], schema))
    assert values(quality.bucketed_diff(left, right, 32)) == values(quality.multiset_diff(left, right))
    assert quality.bucketed_diff(left, left, 32).count() == 0
    assert quality.bucketed_diff(left.limit(0), left.limit(0)).count() == 0
    with pytest.raises(TypeError):
        quality.bucketed_diff(left, right.withColumn("a", F.col("a").cast("long")))


def metric_rows(spark, rows):
    schema = T.StructType(
        [
            T.StructField("vehicle", T.StringType()),
            T.StructField("fuel_type", T.StringType()),
            T.StructField("brand", T.StringType()),
            T.StructField("model", T.StringType()),
            T.StructField("registration_year", T.IntegerType()),
            T.StructField("powertrain_category", T.StringType()),
            T.StructField("co2_combined_g_km", T.DoubleType()),
            T.StructField("net_max_power_kw", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def test_maintained_mart_equals_recomputation(spark):
    def snapshot(n, shift):
        return [
            (f"v{i}", f"f{s}", f"b{(i + shift) % 3}", None if i % 4 else "m", 2000 + i % 2, "c", None if (i + s) % 3 else 0.1 * i + shift, 33.35)
            for i in range(n) for s in range(1 + i % 2)
        ] + [("v0", "f0", "b0", "m", 2000, "c", 1.25, None)] * 2

    one, two = metric_rows(spark, snapshot(30, 0)), metric_rows(spark, snapshot(24, 0) + snapshot(6, 1))
    three = metric_rows(spark, snapshot(3, 2))
    state = maintenance.metric_state(one, "vehicle")
    for before, after in ((one, two), (two, three), (three, three.limit(0)), (three.limit(0), one)):
        state = materialize(maintenance.maintained_state(state, before, after, "vehicle"), "state")
        want = aggregate_metrics(after, "vehicle")
        assert values(maintenance.metrics_of_state(state), *METRIC_KEYS, "vehicle_count") == values(want, *METRIC_KEYS, "vehicle_count")
        assert values(maintenance.metrics_of_state(state)) == values(want)
    assert maintenance.changed_vehicles(one, one, "vehicle").count() == 0
