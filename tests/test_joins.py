import datetime
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from snapharbor import session
from snapharbor.operators import joins, quality, scans
from snapharbor.operators.upsert import resolve_latest, upsert_by_key

DAY = datetime.date(2024, 1, 2)
PAIRS = {
    "int and bigint": ("int", [1, 2, None], "bigint", [2, 3, None]),
    "bigint and smallint": ("bigint", [1, 2, None], "smallint", [2, 3, None]),
    "decimal scales": ("decimal(10,2)", [Decimal("1.10"), Decimal("2.50")], "decimal(10,1)", [Decimal("2.5")]),
    "decimal and int": ("decimal(10,2)", [Decimal("1.10"), Decimal("2.00")], "int", [2]),
    "date and timestamp": ("date", [DAY, datetime.date(2024, 1, 3)], "timestamp", [datetime.datetime(2024, 1, 3)]),
    "float and double": ("float", [1.5, 2.5], "double", [2.5]),
    "zeros": ("double", [1.0, 0.0], "double", [-0.0]),
}


@pytest.mark.parametrize("case", PAIRS)
def test_keys_of_different_types_meet(spark, case):
    left_type, left, right_type, right = PAIRS[case]
    rows = spark.createDataFrame([(v,) for v in left], f"k {left_type}")
    ids = spark.createDataFrame([(v,) for v in right], f"k {right_type}")
    for helper, how in ((joins.keep_ids, "left_semi"), (joins.drop_ids, "left_anti")):
        got = helper(rows, ids, "k")
        assert got.dtypes == rows.dtypes
        assert values(got) == values(rows.join(ids, "k", how))
    assert joins.keep_ids(rows, ids, "k").count() == 1


def test_two_keys_of_different_types(spark):
    rows = spark.createDataFrame([(1, 1, "old"), (1, 2, "old"), (2, 1, "old")], "a int, b int, v string")
    new = spark.createDataFrame([(1, 2, "new"), (3, 1, "new")], "a bigint, b smallint, v string")
    got = upsert_by_key(rows, new, ["a", "b"])
    assert values(got) == [(1, 1, "old"), (1, 2, "new"), (2, 1, "old"), (3, 1, "new")]


def test_versions_with_null_keys(spark):
    log = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 2, "d")], "k int, v int, x string")
    assert values(resolve_latest(log, ["k"], "v"), "x") == [("b",), ("c",), ("d",)]


def test_text_against_numbers_is_refused(spark):
    rows = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(TypeError, match="join key k"):
        joins.keep_ids(rows, spark.range(2).withColumnRenamed("id", "k"), "k")


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_missing_measures_must_stay_missing(spark):
    fuels = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    rows = spark.range(1)
    for df, want in ((fuels, []), (fuels.fillna(0.0), [("fuels", 1)])):
        found = quality.verify_expected(rows, rows, {}, {"fuels": (df, ["a", "b"])})
        assert values(found) == want


def test_prohibited_paths(spark):
    paths = ["src/a.py", "data/x.csv", "a/.env", "b/METADATA.md", "x.DuckDB", "my_data/x.md", "salt/privacy_salt"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert values(scans.scan_paths(df, "path")) == [("a/.env",), ("data/x.csv",), ("salt/privacy_salt",), ("x.DuckDB",)]
    assert scans.scan_paths(df.select(F.lit(None).cast("string").alias("path")), "path").count() == 0
