import json

import pytest
from pyspark.sql import functions as F

from gridtide.plans import analytics, checks, dimensions, facts, reports, staging
from gridtide.operators import sketches, upsert
from gridtide.sources import inline
from gridtide.sources.tables import settle

from .helpers import physical_plan, rows


def _demand(spark, records):
    """(id, upload, authority, period, value) to raw documents."""
    data = [
        (i, f"f{i}", upload, authority, json.dumps({"response": {"data": [{"period": period, "value": value}]}}))
        for i, upload, authority, period, value in records
    ]
    df = spark.createDataFrame(data, "id long, file_name string, up string, balancing_authority string, raw_data string")
    return df.withColumn("uploaded_at", F.col("up").cast("timestamp_ntz")).withColumn("data_date", F.to_date("up"))


def _hours(n, day="2024-01-0", authority="DUK", step=1):
    return [
        (i, f"2024-02-01 00:00:{i % 60:02d}", authority, f"{day}{1 + i // 24}T{i % 24:02d}", str(100 + (i * 37) % 53))
        for i in range(0, n, step)
    ]


def _locations(spark, demand):
    places = dimensions.authority_places(demand)
    return dimensions.describe_places(places, inline.population(spark))


def test_stage_demand_keeps_the_newest_upload(spark):
    raw = _demand(
        spark,
        [
            (1, "2024-01-02", "DUK", "2024-01-01T06", "10"),
            (2, "2024-01-03", "DUK", "2024-01-01T06", "-4.5"),
            (3, "2024-01-03", "DUK", "bad", "1"),
            (4, "2024-01-03", "CPLE", "2024-01-01T06:00:00Z", "x"),
        ],
    )
    got = staging.stage_demand(raw)
    assert rows(got.select("balancing_authority", "demand_mwh", "day_part", "is_negative_demand", "source_id")) == [
        ("CPLE", None, "MORNING_PEAK", False, 4),
        ("DUK", -4.5, "MORNING_PEAK", True, 2),
    ]


def test_stage_sales_filters_states_and_keeps_revisions(spark):
    def doc(state, sales):
        return json.dumps({"response": {"data": [{"period": "2024-01", "stateid": state, "sectorid": "RES", "sales": sales}]}})

    data = [(1, "f", "2024-02-01", doc("NC", "5")), (2, "f", "2024-02-02", doc("NC", "6")), (3, "f", "2024-02-02", doc("SC", "7"))]
    raw = spark.createDataFrame(data, "id long, file_name string, up string, raw_data string").withColumn(
        "uploaded_at", F.col("up").cast("timestamp_ntz")
    )
    staged = staging.stage_sales(raw)
    assert rows(staged.select("state_id", "sales_mwh")) == [("NC", 5.0), ("NC", 6.0)]
    assert staged.select("sales_id").distinct().count() == 1
    assert staging.stage_sales(raw, states=None).count() == 3
    places = spark.createDataFrame([("NC",)], "location_code string").select(
        F.lit("k").alias("location_id"), "location_code", F.lit("State").alias("location_type"),
        F.lit(None).cast("date").alias("valid_from_date"), F.lit(None).cast("date").alias("valid_to_date"),
    )
    assert rows(facts.fact_sales(staged, places).select("sales_mwh", "location_id")) == [(6.0, "k")]


def test_places_missing_from_the_dimension_stay_apart(spark):
    raw = _demand(spark, _hours(3) + [(90 + i, u, "CPLE", p, "1") for i, u, _, p, _ in _hours(3)])
    staged = staging.stage_demand(raw)
    nothing = _locations(spark, staged).limit(0)
    got = facts.fact_demand(staged, nothing)
    assert got.filter("location_id IS NULL").count() == 6
    cple = got.filter("balancing_authority = 'CPLE'").orderBy("timestamp").select("hourly_demand_change_mwh").collect()
    assert [r[0] for r in cple] == [None, 0.0, 0.0]


def test_date_dimension(spark):
    d = dimensions.dim_date(spark, "2024-01-01", 366, as_of="2024-02-29").filter("date = DATE'2024-02-29'").first()
    assert (d.date_id, d.day_of_week, d.day_name, d.month_name, d.quarter_year, d.season) == (
        "20240229", 4, "Thursday", "February", "Q1-2024", "Winter",
    )
    assert str(d.prior_year_date) == "2023-02-28" and d.is_current_date


def test_energy_source_attributes(spark):
    fuels = [("NG", "gas", False, True), ("ALL", "all", False, False), ("BIO", "biomass", False, False)]
    df = spark.createDataFrame(fuels, "fuel_type_id string, fuel_type_name string, is_renewable boolean, is_fossil_fuel boolean")
    got = dimensions.dim_energy_source(df)
    assert rows(got.select("source_key", "source_category", "primary_category", "carbon_intensity_kg_per_mwh", "is_dispatchable")) == [
        (1, "All Sources", "All Sources", None, None),
        (2, "biomass", "Other", None, None),
        (3, "Natural Gas", "Fossil Fuel", 450, True),
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_demand_loaded_in_runs_equals_a_full_refresh(spark, seed):
    """Hours arrive in any order and may be revised: three runs give what one run gives."""
    import random

    chance = random.Random(seed)
    records = []
    for i, (_, _, _, period, value) in enumerate(_hours(60)):
        for revision in range(chance.choice([1, 1, 2])):
            upload = f"2024-02-{chance.randint(1, 9):02d} 00:{i:02d}:{revision:02d}"
            records.append((len(records), upload, chance.choice(["DUK", "CPLE"]), period, str(int(value) + revision)))
    raw = settle(_demand(spark, records))
    staged = staging.stage_demand(raw)
    locations = settle(_locations(spark, staged))
    full = facts.fact_demand(staged, locations)
    table = None
    for bound in ("2024-02-04", "2024-02-07", "2024-03-01"):
        arrived = staging.stage_demand(raw.filter(F.col("uploaded_at") < F.lit(bound).cast("timestamp_ntz")))
        if table is None:
            table = settle(facts.with_partition(facts.fact_demand(arrived, locations), "date"))
        else:
            changes = facts.fact_demand_increment(table, arrived, locations)
            table = settle(upsert.upsert(table, changes, facts.DEMAND_KEYS))
    assert rows(table.select(*full.columns)) == rows(full)


def _daily(spark, start, numbers):
    """One demand row a day for two authorities without a location key."""
    numbered = spark.createDataFrame([(i, code) for i in numbers for code in ("a", "b")], "i int, balancing_authority string")
    return numbered.select(
        F.lit(None).cast("string").alias("location_id"), "balancing_authority",
        F.date_format(F.date_add(F.lit(start).cast("date"), F.col("i")), "yyyyMMdd").alias("date_id"),
        ((F.col("i") * 13) % 29 + F.length("balancing_authority") + F.ascii("balancing_authority") % 7).cast("double").alias("demand_mwh"), "i",
    )


def test_cumulative_increment_equals_full_across_the_year(spark):
    start = "2023-11-15"
    dates = dimensions.dim_date(spark, start, 130)
    demand = _daily(spark, start, range(120))
    target = settle(analytics.cumulative_table(demand.filter("i % 10 <> 3"), dates))
    changes = analytics.cumulative_increment(target, demand, dates, demand.filter("i % 10 = 3 AND i > 40"))
    merged = upsert.upsert(target, changes, analytics.CUMULATIVE_KEYS)
    expected = analytics.cumulative_table(demand.filter("i % 10 <> 3 OR i > 40"), dates)
    exact = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in expected.dtypes]
    assert rows(merged.select(*exact)) == rows(expected.select(*exact))


def test_a_late_day_rewrites_its_reach_only(spark, monkeypatch):
    """Of 1000 days, one late day rewrites itself, the days that look back to it, and its calendar week."""
    monkeypatch.setattr(analytics, "CUMULATIVE_REACH", 90)
    dates = dimensions.dim_date(spark, "2020-01-01", 1000)
    demand = _daily(spark, "2020-01-01", [i for i in range(1000) if i != 500])
    late = _daily(spark, "2020-01-01", [500]).filter("balancing_authority = 'a'")
    target = settle(analytics.cumulative_table(demand, dates))
    changes = analytics.cumulative_increment(target, demand.unionByName(late), dates, late)
    found = changes.agg(F.count("*"), F.min("date"), F.max("date"), F.countDistinct("balancing_authority")).first()
    assert 91 <= found[0] <= 91 + 6 and (found[2] - found[1]).days <= 97 and found[3] == 1


def test_first_load_takes_two_years(spark):
    dates = dimensions.dim_date(spark, "2020-01-01", 1500)
    demand = dates.select(
        F.lit("A").alias("location_id"), F.lit("a").alias("balancing_authority"), "date_id", F.lit(1.0).alias("demand_mwh")
    )
    got = analytics.cumulative_patterns(demand, dates, as_of="2023-06-01").agg(F.min("date").cast("string")).first()[0]
    assert got == "2021-06-01"


def test_generation_mix_with_and_without_sector(spark):
    data = [
        ("20230101", 2023, "S1", 10.0), ("20230101", 2023, "S2", 20.0), ("20240101", 2024, "S1", 30.0), ("20240101", 2024, "S2", None),
    ]
    monthly = spark.createDataFrame(data, "date_id string, year int, sector_id string, generation_mwh double").select(
        "*", F.lit(1).alias("month"), F.lit("L").alias("location_id"), F.lit("E").alias("energy_source_id"),
        F.lit("COW").alias("fuel_type_id"), F.lit("coal").alias("fuel_type_name"), F.lit("Fossil Fuel").alias("primary_category"),
        F.lit(False).alias("is_renewable"), F.lit(True).alias("is_fossil_fuel"), F.lit(False).alias("is_nuclear"),
        F.lit("January").alias("month_name"), F.lit(1).alias("quarter"), F.lit("Winter").alias("season"),
        F.lit(50.0).alias("percentage_of_total"),
    )
    by_sector = analytics.generation_mix(monthly)
    assert rows(by_sector.select("date_id", "sector_id", "previous_year_generation_mwh", "yoy_change_mwh", "estimated_co2_emissions_tons")) == [
        ("20230101", "S1", None, 10.0, 9.0),
        ("20230101", "S2", None, 20.0, 18.0),
        ("20240101", "S1", 10.0, 20.0, 27.0),
        ("20240101", "S2", 20.0, None, None),
    ]
    whole = analytics.generation_mix(monthly, match_sector=False)
    assert rows(whole.select("date_id", "sector_id", "previous_year_generation_mwh", "yoy_change_mwh")) == [
        ("20230101", "S1", None, 30.0),
        ("20230101", "S2", None, 30.0),
        ("20240101", "S1", 30.0, 0.0),
        ("20240101", "S2", 30.0, 0.0),
    ]


def test_kept_sketches_after_a_refresh(spark):
    """Groups far larger than the sketch: merged parts are as near the wanted rank as one pass, and NULLs stay out."""
    values = spark.range(30_000).select(
        F.lit("g").alias("g"), (F.col("id") % 12).alias("part"), F.when(F.col("id") % 10 > 0, (F.col("id") * 7919 % 30_011).cast("double")).alias("v")
    )
    kept = sketches.quantile_sketches(values, ["g"], "part", "v")
    wrong = sketches.quantile_sketches(values.withColumn("v", F.lit(1e9)).filter("part = 3"), ["g"], "part", "v")
    refreshed = upsert.upsert(kept.filter("part < 8 AND part <> 3").unionByName(wrong), kept.filter("part >= 8 OR part = 3"), ["g", "part"])
    ps = {"low": 0.1, "high": 0.9}
    n, slack = values.filter("v IS NOT NULL").count(), 3 * sketches.rank_error()
    one_pass = values.groupBy("g").agg(*[sketches.sketched_percentile("v", p).alias(name) for name, p in ps.items()])
    for found in (sketches.merged_percentiles(refreshed, ["g"], ps).first(), one_pass.first()):
        for name, p in ps.items():
            assert abs(values.filter(F.col("v") <= found[name]).count() / n - p) < slack
    none = values.withColumn("v", F.lit(None).cast("double")).groupBy("g").agg(sketches.sketched_percentile("v", 0.5).alias("p"))
    assert none.first().p is None


def test_all_declared_checks_name_existing_columns(spark, small):
    from workload.registry import Models

    m = Models(spark, small)
    frames = {
        "stage_demand": m.stage_demand,
        "stage_sales": m.stage_sales,
        "stage_weather": m.stage_weather,
        "station_metadata": m.station_metadata,
        "stage_generation": m.stage_generation,
        "dim_date": m.dates,
    }
    for model, frame in frames.items():
        not_null, accepted, unique, _ = checks.DECLARED[model]
        assert {*not_null, *accepted, *unique} <= set(frame.columns)
    found = rows(checks.check_model("dim_date", frames).filter("violations > 0"))
    assert found == []


def test_reports_pick_their_columns(spark):
    drivers = spark.createDataFrame(
        [("id", "2024-01-01 00:00:00", True, 1.0, None, -2.0)],
        "peak_driver_id string, timestamp string, is_peak_hour boolean, weather_contribution_mwh double, "
        "weekend_contribution_mwh double, time_of_day_contribution_mwh double",
    )
    assert rows(reports.drivers_long(drivers).select("driver", "contribution_mwh")) == [
        ("TIME_OF_DAY_IMPACT", -2.0), ("WEATHER_IMPACT", 1.0), ("WEEKEND_IMPACT", None),
    ]


def test_hourly_staging_equals_dedup_in_the_fact(spark, small):
    from workload.registry import Models

    m = Models(spark, small)
    shifted = m.raw_weather.withColumn("raw_data", F.expr("replace(raw_data, ':00:00Z', concat(':', lpad(id % 60, 2, '0'), ':00Z'))"))
    twice = facts.weather_base(staging.stage_weather(shifted), m.stations_table)
    once = facts.weather_base(staging.stage_weather(shifted, per_hour=True), m.stations_table, hourly=True)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_no_join_is_a_nested_loop(spark, small):
    from workload.registry import QUERIES, Models

    for name in ("q_bridge", "q_state_changes", "q_weather_demand_correlation", "q_generation_mix", "q_fact_sales"):
        plan = physical_plan(QUERIES[name](Models(spark, small)))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_renamed_codes_stay_one_row(spark):
    staged = spark.createDataFrame(
        [("NG", "gas", False, True, "VA", "Virginia", 1, 1), ("NG", "natural gas", False, True, "VA", "Commonwealth", 2, 2)],
        "fuel_type_id string, fuel_type_name string, is_renewable boolean, is_fossil_fuel boolean, location_code string, "
        "state_name string, source_timestamp int, source_id int",
    )
    assert [r.fuel_type_name for r in dimensions.dim_energy_source(staged).collect()] == ["natural gas"]
    assert [r.state_name for r in dimensions.state_places(staged).collect()] == ["Commonwealth"]
