import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapharbor.operators import upsert

SCHEMA = "k string, s int, v int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_upsert_replaces_by_key_and_keeps_batch_duplicates(spark):
    target = frame(spark, [("a", 1, 1), ("a", 2, 1), ("b", 1, 1), (None, 1, 1)])
    incoming = frame(spark, [("a", 1, 2), ("a", 1, 3), ("c", 1, 2), (None, 1, 2)])
    got = values(upsert.upsert_by_key(target, incoming, ["k", "s"]))
    # a NULL key matches nothing, so both NULL rows stay
    assert got == [
        (None, 1, 1), (None, 1, 2),
        ("a", 1, 2), ("a", 1, 3), ("a", 2, 1), ("b", 1, 1), ("c", 1, 2),
    ]
    last = upsert.upsert_by_key(target, incoming, ["k", "s"], "last", [F.col("v")])
    assert ("a", 1, 2) not in values(last)


def test_upsert_options_are_checked(spark):
    df = frame(spark, [("a", 1, 1)])
    with pytest.raises(ValueError):
        upsert.upsert_by_key(df, df, ["k"], dedupe="first")
    with pytest.raises(ValueError):
        upsert.upsert_by_key(df, df, ["k"], dedupe="last")


def test_keep_last_orders_null_first(spark):
    df = frame(spark, [("a", 1, None), ("a", 2, 5), ("a", 3, 4), ("b", 1, None)])
    got = upsert.keep_last(df, ["k"], [F.col("v"), F.col("s")])
    assert values(got) == [("a", 2, 5), ("b", 1, None)]


def test_log_equals_upserts_in_order(spark):
    batches = [
        [("a", 1, 1), ("b", 1, 1), (None, 1, 1)],
        [("a", 1, 2), ("a", 1, 3), ("c", 1, 1)],
        [("b", 2, 9), (None, 1, 2)],
    ]
    table = frame(spark, [])
    for rows in batches:
        table = upsert.upsert_by_key(table, frame(spark, rows), ["k", "s"])
    log = spark.createDataFrame(
        [(*r, i) for i, rows in enumerate(batches) for r in rows], SCHEMA + ", version int"
    )
    assert values(upsert.resolve_latest(log, ["k", "s"], "version")) == values(table)


ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 2), st.integers(0, 3)), max_size=6
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_upsert_is_idempotent(spark, target, incoming):
    once = upsert.upsert_by_key(frame(spark, target), frame(spark, incoming), ["k", "s"])
    twice = upsert.upsert_by_key(once, frame(spark, incoming), ["k", "s"])
    assert values(once) == values(twice)


def test_empty_guard(spark):
    with pytest.raises(upsert.EmptySnapshotError):
        upsert.require_rows(frame(spark, []), "nothing left")
