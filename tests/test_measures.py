import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from snapharbor.plans import measures as ms
from snapharbor.plans import reports


@pytest.fixture(scope="module")
def over(models):
    return models["mart_ev_overview"].cache()


@pytest.fixture(scope="module")
def fuel(models):
    return models["fact_vehicle_fuel"].cache()


def one(df):
    return df.first().asDict()


def test_totals(over, fuel):
    assert one(ms.measure(over, fuel, ["vehicles", "multi_fuel_vehicles", "multi_fuel_share"])) == {
        "vehicles": 6, "multi_fuel_vehicles": 4, "multi_fuel_share": pytest.approx(4 / 6)
    }
    cards = one(reports.fuel_cards(over, fuel))
    assert cards["fuel_records"] == 10 and cards["vehicles_with_fuel"] == 6
    assert cards["co2_coverage"] == 0.2 and cards["avg_power"] == pytest.approx(112.75)


def test_zero_is_not_blank(over, fuel):
    battery = {"powertrain_category": ["Battery electric"]}
    row = one(ms.measure(over, fuel, ["multi_fuel_vehicles", "multi_fuel_share"], filters=battery))
    assert row == {"multi_fuel_vehicles": 0, "multi_fuel_share": 0.0}
    row = one(reports.fuel_cards(over, fuel, battery))
    assert row["co2_coverage"] == 0.0 and row["avg_co2"] is None and row["power_coverage"] == 1.0


def test_no_rows_is_blank(over, fuel):
    nothing = {"brand": ["NONE"]}
    row = one(ms.measure(over, fuel, ["vehicles", "multi_fuel_vehicles", "multi_fuel_share"], filters=nothing))
    assert set(row.values()) == {None}
    row = one(reports.fuel_cards(over, fuel, nothing))
    assert row["fuel_records"] == 0 and row["co2_coverage"] is None


def test_filters_go_one_way(over, fuel):
    petrol = {"fuel_type": ["Benzine"]}
    assert one(ms.measure(over, fuel, ["vehicles"], filters=petrol)) == {"vehicles": 6}
    assert one(ms.measure(over, fuel, ["fuel_records"], filters=petrol)) == {"fuel_records": 2}
    both = {"fuel_type": ["Elektriciteit"], "brand": ["ACME"]}
    assert one(ms.measure(over, fuel, ["fuel_records"], filters=both)) == {"fuel_records": 2}


def test_fuel_measures_by_overview_column(over, fuel):
    got = ms.measure(over, fuel, ["fuel_records"], by=("powertrain_category",))
    assert values(got) == [("Battery electric", 1), ("Hybrid electric", 6), ("Hydrogen electric", 3)]


def test_overview_measures_do_not_vary_by_fuel(over, fuel):
    with pytest.raises(ValueError):
        ms.measure(over, fuel, ["vehicles"], by=("fuel_type",))
    with pytest.raises(ValueError):
        ms.measure(over, fuel, ["vehicles", "fuel_records"])


def test_powertrain_share_lifts_only_its_filter(over):
    got = ms.powertrain_share(over, filters={"powertrain_category": ["Hybrid electric"]})
    assert values(got) == [("Hybrid electric", 3, 0.5)]
    by_brand = ms.powertrain_share(
        over, by=("brand",), filters={"powertrain_category": ["Hybrid electric"]}
    )
    assert values(by_brand) == [("ACME", 1, 0.5), ("BETA", 1, 1.0), ("DELTA", 1, 1.0)]
    both = ms.powertrain_share(over, by=("brand", "powertrain_category"), filters={"brand": ["ACME"]})
    assert values(both, "powertrain_category", "share") == [
        ("Battery electric", 0.5), ("Hybrid electric", 0.5)
    ]


def test_rollup_tells_subtotals_from_null(over, fuel):
    rows = reports.fuel_matrix(over, fuel).collect()
    null_class = [r for r in rows if r["fuel_type"] == "Diesel" and r["hybrid_class"] is None]
    assert [r["level"] for r in null_class] == [1]
    petrol = [(r["level"], r["fuel_records"]) for r in rows if r["fuel_type"] == "Benzine"]
    assert sorted(petrol) == [(0, 2), (1, 2)]
    total = [r for r in rows if r["level"] == 3]
    assert total[0]["vehicles_with_fuel"] == 6 and len(total) == 1


def test_calendar_spans_whole_years(over):
    days = ms.calendar_dim(over, "registration_date")
    assert days.count() == 365 * 4 + 366
    row = days.where("date = '2020-02-29'").first()
    assert (row["month"], row["quarter"], row["day"]) == ("February", "Qtr 1", 29)
    empty = ms.calendar_dim(over.where("false"), "registration_date")
    assert empty.count() == 0


def test_date_part_join_ignores_the_time(spark, over):
    stamps = spark.createDataFrame(
        [(datetime.datetime(2020, 1, 15, 23, 59),), (datetime.datetime(2020, 1, 15),), (None,)],
        "ts timestamp",
    )
    days = ms.calendar_dim(over, "registration_date").select("date")
    assert values(ms.date_part_join(stamps, "ts", days, "n")) == [(datetime.date(2020, 1, 15), 2)]


def test_date_hierarchy_adds_up(over):
    got = ms.date_hierarchy(over, "registration_date", F.sum("vehicle_count"), "n").collect()
    by_level = {}
    for r in got:
        by_level.setdefault(r["level"], 0)
        by_level[r["level"]] += r["n"]
    assert by_level == {0: 5, 1: 5, 3: 5, 7: 5, 15: 5}


def test_top_brands_and_example_queries(over, models):
    assert values(reports.top_brands(over, 1)) == [("ACME", 2), ("GAMMA", 2)]
    assert len(reports.brand_by_powertrain(over, 1).collect()) == 3
    assert reports.q_top_brands(over).first()["brand"] == "ACME"
    assert reports.q_year_profile(over).count() == 5
    assert reports.q_metrics_top50(models["mart_ev_metrics"]).count() == 10
    assert values(reports.q_snapshot_grain(models["fact_vehicle_snapshot"])) == [("run-1", 6, 10)]


def test_unknown_filters_are_refused(over, fuel):
    with pytest.raises(ValueError, match="brnad"):
        ms.measure(over, fuel, ["vehicles"], filters={"brnad": ["ACME"]})
    with pytest.raises(ValueError, match="fuel_type"):
        ms.powertrain_share(over, filters={"fuel_type": ["Benzine"]})
