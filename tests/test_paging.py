import pytest
from conftest import values
from pyspark.sql import functions as F

from snapharbor.operators import matching, paging
from snapharbor.session import materialize


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"))
    got = {r["id"]: r["position"] for r in paging.global_position(df, F.col("id")).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1])] == sorted(got)
    assert sorted(got.values()) == list(range(1000))


def test_positions_split_one_hot_value(spark):
    df = spark.range(4000).select(F.lit("same").alias("id"), F.col("id").alias("n"))
    placed = paging.global_position(df, F.col("id"))
    assert sorted(r["position"] for r in placed.collect()) == list(range(4000))
    assert placed.where("n is null").count() == 0


def test_number_pages_and_batches(spark):
    pages = paging.number_pages(ids(spark, ["c", "a", "b"]), "id", 2)
    assert values(pages, "id", "page", "pos") == [("a", 0, 0), ("b", 0, 1), ("c", 1, 0)]
    batches = paging.batch_assign(ids(spark, ["b", " ", "a", "a", None, "c"]), "id", 2)
    assert values(batches, "id", "batch") == [("a", 0), ("b", 0), ("c", 1)]


@pytest.mark.parametrize("size", [0, -1, 50_001])
def test_page_size_is_checked(spark, size):
    with pytest.raises(ValueError):
        paging.number_pages(ids(spark, ["a"]), "id", size)


def test_keyset_page_moves_on(spark):
    rows = [("a", "E"), ("b", "X"), ("c", "W"), ("c", "E"), ("d", "E"), ("e", "E")]
    df = spark.createDataFrame(rows, "id string, kind string")

    def page(after):
        return [r["id"] for r in paging.keyset_page(df, "id", "kind", ("E", "W"), after, 2).collect()]

    assert page(None) == ["a", "c"]
    assert page("c") == ["d", "e"]
    assert page("e") == []


def test_snapshot_cap(spark):
    df = ids(spark, ["d", "b", "a", "c", "a"])
    assert [r["id"] for r in paging.snapshot_cap(df, "id", 3).collect()] == ["a", "b", "c"]
    assert paging.snapshot_cap(df, "id", None).count() == 4


def test_offset_pages_are_sorted_and_ties_are_settled(spark):
    rows = [(i % 3, f"{i:03d}") for i in range(50)]
    df = spark.createDataFrame(rows, "k int, id string").repartition(7)
    want = [r[1] for r in sorted(rows)]
    for offset, limit in ((0, 5), (20, 7), (45, 10), (60, 3)):
        got = [r["id"] for r in paging.offset_page(df, [F.col("k")], offset, limit).collect()]
        assert got == want[offset : offset + limit]


def test_ranges_grow_with_the_input(spark, monkeypatch):
    df = spark.range(1000)
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert paging.range_count(df) == default
    monkeypatch.setattr(paging, "RANGE_BYTES", 100)
    assert paging.range_count(df) == 80


def test_order_guard(spark, monkeypatch):
    monkeypatch.setattr(paging, "CHUNK_ROWS", 2)
    good = [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (0, 3, " "), (0, 4, "d"), (1, 0, "e")]
    frame = "page long, pos long, id string"
    assert paging.page_order_guard(spark.createDataFrame(good, frame), "id").collect() == []
    bad = [
        (0, 0, "a"), (0, 1, "a"),  # repeated inside a chunk
        (0, 2, "a"),  # repeated across a chunk border
        (1, 0, "a"), (1, 1, "z"),  # does not go beyond the page before
        (2, 0, "b"),
    ]
    found = paging.page_order_guard(spark.createDataFrame(bad, frame), "id")
    assert values(found, "page", "pos", "violation") == [
        (0, 1, "not_increasing"),
        (0, 2, "not_increasing"),
        (1, 0, "not_advanced"),
        (2, 0, "not_advanced"),
    ]


@pytest.mark.parametrize("block", [2, 10_000])
def test_order_guard_across_gaps(spark, monkeypatch, block):
    monkeypatch.setattr(paging, "CHUNK_ROWS", block)
    frame = "page long, pos long, id string"
    gap = [(0, 0, "a"), (0, 1, "m"), (7, 0, "c"), (7, 1, "z"), (9, 0, " "), (30, 0, "y"), (31, 0, "zz")]
    found = paging.page_order_guard(spark.createDataFrame(gap, frame), "id")
    assert values(found, "page", "id", "prev_id", "violation") == [
        (30, "y", "z", "not_advanced"), (7, "c", "m", "not_advanced")
    ]


def test_running_totals_across_blocks(spark):
    df = spark.range(25).select(F.lit("r").alias("run"), F.col("id").alias("page"), F.lit(2).alias("n"))
    got = paging.running_totals(df, "run", "page", ["n"], block=4).orderBy("page").collect()
    assert [r["total_n"] for r in got] == [2 * (i + 1) for i in range(25)]


def test_resume_cursor(spark):
    pages = spark.createDataFrame(
        [(0, "a"), (0, " c "), (1, " "), (1, None), (2, "d"), (3, "e")], "page long, id string"
    )

    def cursor(*commits):
        rows = spark.createDataFrame(commits, "page long, committed boolean, digest string, landed_digest string")
        return paging.resume_cursor(pages, rows, "id").first()["cursor"]

    sound = [(p, True, "x", "x") for p in range(4)]
    assert cursor(*sound) == "e"
    assert cursor(*sound[:2]) == "c"
    assert cursor(*sound[:2], (2, False, "x", "x"), sound[3]) == "c"
    assert cursor(*sound[:3], (3, True, "x", "changed")) == "d"
    assert cursor((0, True, "x", None), *sound[1:]) is None


def datasets(spark):
    anchors = spark.createDataFrame(
        [(0, "a"), (0, "b"), (0, " "), (1, "c"), (1, "d"), (2, "")], "page long, id string"
    )
    vehicles = spark.createDataFrame([("a ",), ("a",), ("b",), ("c",), ("x",), (None,)], "id string")
    fuels = spark.createDataFrame([("a",), ("a",), ("c",), ("c",), ("c",), ("d",)], "id string")
    return anchors, vehicles, fuels


def test_completeness_needs_both_datasets(spark):
    anchors, vehicles, fuels = datasets(spark)
    complete = matching.complete_ids(anchors, vehicles, fuels, "id")
    assert values(complete, "page", "id") == [(0, "a"), (1, "c")]
    assert matching.complete_rows(vehicles, complete, "id").count() == 3


def test_page_counters(spark):
    counters = matching.page_counters(*datasets(spark), "id")
    got = values(counters, "page", "source_rows", "matched", "fuel_rows", "rejected")
    # source = anchors + detail rows; rejected = blank anchors + incomplete ids
    assert got == [(0, 8, 2, 2, 2), (1, 7, 1, 3, 1), (2, 1, 0, 0, 1)]
    total = matching.cumulative_counters(
        counters.withColumn("run", F.lit("r")), "run", "page", ["rejected"]
    )
    assert [r["total_rejected"] for r in total.orderBy("page").collect()] == [2, 3, 4]


def awkward(spark, n=4000):
    """Rows with ties, nulls, dates, instants, decimals and text."""
    return spark.range(n).select(
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") * 7919 % 101).alias("k"),
        F.expr("date_add(date'2020-01-01', cast(id * 31 % 17 as int))").alias("d"),
        F.expr("timestamp_micros(1600000000000000 + id * 7 % 1000)").alias("t"),
        F.expr("cast(id % 13 as decimal(12,2))").alias("m"),
        F.concat(F.lit("é"), F.lpad((F.col("id") * 37 % n).cast("string"), 5, "0")).alias("s"),
        F.col("id"),
    )


@pytest.mark.parametrize("columns", [["k"], ["s"], ["d", "k"], ["t"], ["m", "s"]])
def test_offset_page_sorts_only_the_neighbourhood(spark, monkeypatch, columns):
    monkeypatch.setattr(paging, "DIRECT_ROWS", 150)
    monkeypatch.setattr(paging, "SAMPLE_ROWS", 200)
    df = materialize(awkward(spark), "awkward")
    order = [F.col(c) for c in columns]
    rows = [tuple(r) for r in df.orderBy(*paging.total_order(df, order)).collect()]
    sorted_rows = []
    real = paging._neighbourhood

    def watched(*args):
        found = real(*args)
        sorted_rows.append(found[2])
        return found

    monkeypatch.setattr(paging, "_neighbourhood", watched)
    written = []
    monkeypatch.setattr(paging, "materialize", lambda *a: written.append(a))
    for offset, limit in ((0, 10), (1234, 50), (3990, 40), (5000, 10), (77, 0)):
        page = paging.offset_page(df, order, offset, limit)
        assert [tuple(r) for r in page.collect()] == rows[offset : offset + limit]
    assert max(sorted_rows) <= 150 and written == []
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 0


def test_offset_page_of_equal_rows_and_of_descending_order(spark, monkeypatch):
    monkeypatch.setattr(paging, "DIRECT_ROWS", 20)
    monkeypatch.setattr(paging, "SAMPLE_ROWS", 50)
    same = materialize(spark.range(500).select(F.lit(1).alias("k"), F.lit("x").alias("s")), "same")
    assert paging.offset_page(same, [F.col("k")], 300, 7).count() == 7
    assert paging.offset_page(same, [F.col("k")], 498, 7).count() == 2
    down = paging.offset_page(awkward(spark, 300), [F.col("id").desc()], 10, 3)
    assert [r["id"] for r in down.collect()] == [289, 288, 287]


def test_snapshot_cap_in_the_order_of_arrival(spark, monkeypatch):
    monkeypatch.setattr(paging, "DIRECT_ROWS", 20)
    rows = spark.range(200).select(
        F.sha2(F.col("id").cast("string"), 256).alias("h"), F.floor(F.col("id") / 7).alias("page"), (F.col("id") % 7).alias("pos")
    )
    got = paging.snapshot_cap(rows.unionByName(rows.withColumn("page", F.col("page") + 50)), "h", 9, ["page", "pos"])
    want = rows.where("page = 0 or (page = 1 and pos < 2)").select("h")
    assert values(got) == values(want)
