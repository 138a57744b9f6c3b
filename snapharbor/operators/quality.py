"""Data tests. Each returns the violations; an empty result is a pass."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.functions.keys import packed, unpacked
from snapharbor.session import materialize


class DataQualityError(RuntimeError):
    """At least one data test found violations."""


def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def dq_unique_expr(df: DataFrame, expr: Column, name: str = "value") -> DataFrame:
    """Values of ``expr`` seen more than once; NULL is ignored."""
    return (
        df.select(expr.alias(name))
        .where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
    )


def dq_unique(df: DataFrame, col: str) -> DataFrame:
    """The same of a column; text keys are packed on their way."""
    if dict(df.dtypes)[col] != "string":
        return dq_unique_expr(df, F.col(col), col)
    return dq_unique_expr(df, packed(F.col(col)), col).withColumn(col, unpacked(F.col(col)))


def dq_relationship(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Non-NULL child keys without a parent, with the number of child rows.

    Both sides are reduced to one row per key before they meet; text keys are packed on their way.
    """
    if dict(child.dtypes)[child_key] == dict(parent.dtypes)[parent_key] == "string":
        child = child.select(packed(F.col(child_key)).alias(child_key))
        parent = parent.select(packed(F.col(parent_key)).alias(parent_key))
        lost = _without_parent(child, child_key, parent, parent_key)
        return lost.withColumn(child_key, unpacked(F.col(child_key)))
    return _without_parent(child, child_key, parent, parent_key)


def _without_parent(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    keys = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(child_key)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return keys.join(parents, child_key, "left_anti")


def dq_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Values outside the accepted list, with their row counts; NULL passes."""
    return (
        df.where(~F.col(col).isin(*values))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def count_reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(model, expected, actual) row counts; one row per pair."""
    sides = []
    for name, (expected, actual) in pairs.items():
        for side, df in (("expected", expected), ("actual", actual)):
            sides.append(
                df.agg(F.count(F.lit(1)).alias("rows")).select(
                    F.lit(name).alias("model_name"), F.lit(side).alias("side"), "rows"
                )
            )
    counts = reduce(DataFrame.unionByName, sides)
    return counts.groupBy("model_name").agg(
        F.max(F.when(F.col("side") == "expected", F.col("rows"))).alias("expected_rows"),
        F.max(F.when(F.col("side") == "actual", F.col("rows"))).alias("actual_rows"),
    )


def count_mismatch(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    return count_reconcile(pairs).where(F.col("expected_rows") != F.col("actual_rows"))


def multiset_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with the surplus side and its size.

    One scan and one exchange: +1 and -1 are summed per distinct row. ``copies`` stands
    for that many equal rows, so a heavily repeated row stays one row.
    """
    cols = expected.columns
    both = expected.select(*cols, F.lit(1).alias("_n")).unionByName(
        actual.select(*cols, F.lit(-1).alias("_n"))
    )
    net = both.groupBy(*cols).agg(F.sum("_n").alias("_net")).where(F.col("_net") != 0)
    return net.select(
        *cols,
        F.when(F.col("_net") > 0, "expected").otherwise("actual").alias("side"),
        F.abs("_net").alias("copies"),
    )


def bucket_checksums(df: DataFrame, buckets: int | None = None, by: str | None = None) -> DataFrame:
    """(bucket, rows, two sums of row hashes) of a table; one row per bucket and task is moved.

    Rows are dealt into ``buckets`` by a hash of all columns, or by the column ``by``.
    """
    cols = [F.col(c) for c in df.columns]
    dealt = F.col(by) if by else F.pmod(F.xxhash64(*cols, F.lit("bucket")), F.lit(buckets))
    hashed = df.select(
        dealt.alias("bucket"),
        F.xxhash64(*cols).cast("decimal(38,0)").alias("x"),
        F.xxhash64(F.lit("again"), *cols).cast("decimal(38,0)").alias("y"),
    )
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("x").alias("x"), F.sum("y").alias("y")
    )


def differing_buckets(
    expected: DataFrame, actual: DataFrame, buckets: int | None = None, by: str | None = None
) -> DataFrame:
    """(bucket) of those whose checksums differ. Columns must have the same types on both sides."""
    actual = actual.select(*expected.columns)
    if [f.dataType for f in expected.schema] != [f.dataType for f in actual.schema]:
        raise TypeError("the two sides differ in the type of a column")
    sums = bucket_checksums(expected, buckets, by).unionByName(
        bucket_checksums(actual, buckets, by).select(
            "bucket", (-F.col("rows")).alias("rows"), (-F.col("x")).alias("x"), (-F.col("y")).alias("y")
        )
    )
    net = sums.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("rows", "x", "y")])
    return net.where("rows <> 0 or x <> 0 or y <> 0").select("bucket")


def bucketed_diff(expected: DataFrame, actual: DataFrame, buckets: int = 4096) -> DataFrame:
    """``multiset_diff`` for tables that are mostly equal.

    Rows are dealt into buckets by a hash of all columns. Sums of row hashes per bucket, 128 bits,
    tell which buckets differ, and only rows of those are moved: equal tables exchange a row per
    bucket. Columns must have the same types on both sides. Both tables are read twice.
    """
    cols = expected.columns
    apart = [r["bucket"] for r in differing_buckets(expected, actual, buckets).collect()]

    def part(df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*[F.col(c) for c in cols], F.lit("bucket")), F.lit(buckets))
        return df.where(bucket.isin(apart)) if apart else df.limit(0)

    return multiset_diff(part(expected), part(actual))


def dq_date_range(df: DataFrame, col: str) -> DataFrame:
    """Dates before 1900 or more than a year ahead."""
    ahead = F.add_months(F.current_date(), 12)
    return df.select(col).where(
        (F.col(col) < F.lit("1900-01-01").cast("date")) | (F.col(col) > ahead)
    )


def dq_below(df: DataFrame, bounds: dict[str, tuple[Column, float]]) -> DataFrame:
    """One labelled row per value below its bound; all bounds in one scan."""
    labels = F.array(
        *[F.when(col < low, F.lit(label)) for label, (col, low) in bounds.items()]
    )
    return df.select(F.explode(F.array_compact(labels)).alias("failing_measure"))


def verify_expected(
    actual: DataFrame,
    expected: DataFrame,
    counts: dict[str, tuple[DataFrame, int]],
    with_nulls: dict[str, tuple[DataFrame, list[str]]] | None = None,
) -> DataFrame:
    """(finding, violations): differing rows, relations with an unexpected size, and
    relations in which no row misses all of its optional measures: there, missing
    values were turned into numbers."""
    findings = [
        multiset_diff(expected, actual.select(*expected.columns))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("violations"))
        .select(F.lit("rows").alias("finding"), "violations")
    ]
    for name, (df, wanted) in counts.items():
        gap = F.abs(F.count(F.lit(1)) - F.lit(wanted)).alias("violations")
        findings.append(df.agg(gap).select(F.lit(name).alias("finding"), "violations"))
    for name, (df, measures) in (with_nulls or {}).items():
        empty = reduce(and_, [F.col(c).isNull() for c in measures])
        none_left = (F.count(F.when(empty, F.lit(1))) == 0).cast("long").alias("violations")
        findings.append(df.agg(none_left).select(F.lit(name).alias("finding"), "violations"))
    return reduce(DataFrame.unionByName, findings).where(F.col("violations") > 0)


def run_unique_tests(tests: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(check, violations) of tests that the values of an expression are unique, NULL ignored.

    A first pass counts hashes, of all tests together; only values whose hash is there twice
    are grouped by themselves.
    """
    names = list(tests)
    hashes = [
        df.select(F.lit(i).alias("test"), expr.alias("v")).where("v is not null").select("test", F.xxhash64("v").alias("_hash"))
        for i, (df, expr) in enumerate(tests.values())
    ]
    counted = reduce(DataFrame.unionByName, hashes).groupBy("test", "_hash").agg(F.count(F.lit(1)).alias("n"))
    twice = materialize(counted.where("n > 1").select("test", "_hash"), "repeated-hashes")
    found = {names[r["test"]]: r["test"] for r in twice.select("test").distinct().collect()}
    exact = {}
    for name, i in found.items():
        df, expr = tests[name]
        rows = df.select(expr.alias("value")).withColumn("_hash", F.xxhash64("value"))
        rows = rows.join(twice.where(F.col("test") == i), "_hash", "left_semi")
        exact[name] = dq_unique(rows, "value")
    clean = [(name, 0) for name in names if name not in found]
    parts = [twice.sparkSession.createDataFrame(clean, "check string, violations bigint")]
    return reduce(DataFrame.unionByName, [*parts, *([run_tests(exact)] if exact else [])])


def run_tests(tests: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) of every test."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check"), "violations"
        )
        for name, df in tests.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def raise_on_violations(checks: DataFrame) -> dict[str, int]:
    """Collect one row per check and raise if any found something."""
    found = {r["check"]: r["violations"] for r in checks.collect()}
    failures = {name: n for name, n in found.items() if n}
    if failures:
        raise DataQualityError(f"Data-quality checks failed: {failures}")
    return found
