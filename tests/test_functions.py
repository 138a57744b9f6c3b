import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from snapharbor.functions import keys, text


def apply(spark, inputs, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_strip_removes_all_whitespace(spark):
    inputs = ["\t a \u00a0", "\u3000b\x1f", " \t\n ", None, "c d"]
    assert apply(spark, inputs, text.strip) == ["a", "b", "", None, "c d"]


def test_clean_text_and_upper(spark):
    assert apply(spark, [" x ", "\t", None], text.clean_text) == ["x", None, None]
    assert apply(spark, [" x ", "\t", "straße"], text.clean_upper) == ["X", None, "STRASSE"]


def test_default_text(spark):
    assert apply(spark, ["", None, " a"], lambda c: text.default_text(c, "Unknown")) == [
        "Unknown",
        "Unknown",
        "a",
    ]


def test_compact_dates(spark):
    inputs = ["20231399", "", None, "20240229", "20230229", "00000101", "2023-1-1", " 20200115\t", "00010101"]
    day = datetime.date
    assert apply(spark, inputs, text.parse_compact_date) == [
        None, None, None, day(2024, 2, 29), None, None, None, day(2020, 1, 15), day(1, 1, 1)
    ]


def test_decimals_accept_comma_and_reject_lookalikes(spark):
    inputs = ["1,5", "153.00", "12d", "1f", "NaN", "Infinity", "1_000", "", None, " -2 ", ".5", "1e2", "1,2,3"]
    assert apply(spark, inputs, text.parse_decimal_comma) == [
        1.5, 153.0, None, None, None, None, None, None, None, -2.0, 0.5, 100.0, None
    ]


def test_integers_default_when_missing_invalid_or_zero(spark):
    inputs = ["2", "0", "x", "", None, " 3 ", "1.5", "99999999999", "-4"]
    assert apply(spark, inputs, text.parse_int_default) == [2, 1, 1, 1, 1, 3, 1, 1, -4]


def test_typed_views_trim_spaces_only(spark):
    assert apply(spark, [" a ", "  ", "\t"], text.blank_to_null) == ["a", None, "\t"]


def test_round_by_scaling(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.255,), (0.125,)], "x double")
    got = [r[0] for r in df.select(text.round_half_away(F.col("x"), 2)).collect()]
    assert got == [1.0, 2.68, -1.25, 0.13]


def test_salted_hash_is_stable(spark):
    got = apply(spark, ["AB12"], lambda c: keys.salted_sha256(c, "s"))[0]
    assert got == hashlib.sha256(b"s:AB12").hexdigest()
    assert got != apply(spark, ["AB12"], lambda c: keys.salted_sha256(c, "t"))[0]


def test_salted_hash_of_null(spark):
    assert apply(spark, [None], lambda c: keys.salted_sha256(c, "s")) == [None]
    required = apply(spark, ["AB12"], lambda c: keys.salted_sha256(c, "s", required=True))
    assert required == apply(spark, ["AB12"], lambda c: keys.salted_sha256(c, "s"))


def test_md5_keys_and_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "<unknown>"), ("a|b", "c")], "x string, y string")
    plain = [r[0] for r in df.select(keys.md5_key(F.col("x"), F.col("y"))).collect()]
    safe = [
        r[0]
        for r in df.select(keys.md5_key(F.col("x"), F.col("y"), null_token="<unknown>")).collect()
    ]
    assert plain[0] is None
    assert plain[2] == hashlib.md5(b"a|b|c").hexdigest()
    assert safe[0] == safe[1] == hashlib.md5(b"a|<unknown>").hexdigest()


@pytest.mark.parametrize("text_date,key", [("2024-02-09", 20240209), (None, None)])
def test_date_key(spark, text_date, key):
    df = spark.createDataFrame([(text_date,)], "d string")
    assert df.select(keys.date_key(F.col("d").cast("date"))).first()[0] == key
