import random
import re
from datetime import date

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from gridtide.operators import dedup, joins, quality, ranks, series, states, stats, upsert, versions
from gridtide.sources import tables

from .helpers import final_plan, physical_plan, rows, values

PROPERTY = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_latest_by_upload_then_id(spark):
    data = [("a", 1, 9), ("a", 2, 3), ("a", 2, 4), ("b", 1, 1)]
    random.shuffle(data)
    df = spark.createDataFrame(data, "k string, upload int, id int")
    assert rows(dedup.latest_by(df, ["k"], ["upload", "id"])) == [("a", 2, 4), ("b", 1, 1)]
    assert rows(dedup.first_by(df, ["k"], ["upload", "id"])) == [("a", 1, 9), ("b", 1, 1)]


def test_dedup_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = physical_plan(dedup.latest_by(df, ["k"], ["id"]))
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle


def test_dominant_puts_null_first_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("m", 5.0, "x"), ("m", 5.0, "y"), ("n", None, "z"), ("n", 3.0, "w")], "g string, v double, fuel string"
    )
    got = df.groupBy("g").agg(*dedup.dominant("v", {"top": "fuel"}, ["fuel"]).values())
    assert rows(got) == [("m", "y"), ("n", "z")]


def test_number_rows_counts_through_cells(spark):
    words = ["b", "ab", "aa", "zz", "ac", "", "c1", "c2"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert rows(dedup.number_rows(df, "w", "n")) == [(w, i) for i, w in enumerate(sorted(words), start=1)]


def test_validity_join_open_and_closed_bounds(spark):
    fact = spark.sql("SELECT 'a' k, DATE'2024-01-01' d")
    versions = spark.sql(
        "SELECT 'a' code, 'open' v, CAST(NULL AS DATE) valid_from_date, CAST(NULL AS DATE) valid_to_date "
        "UNION ALL SELECT 'a', 'later', DATE'2024-06-01', NULL"
    )
    assert rows(joins.validity_join(fact, versions, ("k", "code"), "d", ["v"]).select("v")) == [("open",)]
    later = versions.filter("v = 'later'")
    assert rows(joins.validity_join(fact, later, ("k", "code"), "d", ["v"]).select("v")) == [(None,)]


@PROPERTY
@given(st.lists(st.tuples(st.sampled_from("aab"), st.integers(0, 400), st.integers(1, 60)), max_size=12), st.sampled_from([1, 7, 500]))
def test_validity_by_stretches_equals_the_plain_join(spark, spans, days):
    start = F.lit("2024-01-01").cast("date")
    facts = spark.range(0, 500, 3).select(F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("k"), F.date_add(start, F.col("id").cast("int")).alias("d"))
    facts = facts.unionByName(spark.createDataFrame([("a", None), (None, None)], "k string, d date"))
    made = spark.createDataFrame([(k, a, n, i) for i, (k, a, n) in enumerate(spans)] + [("b", None, None, 99)], "code string, a int, n int, v int")
    dimension = made.select(
        "code", "v", F.date_add(start, F.col("a")).alias("valid_from_date"), F.date_add(F.date_add(start, F.col("a")), F.col("n")).alias("valid_to_date")
    )
    plain = joins.validity_join(facts, dimension, ("k", "code"), "d", ["v"])
    assert rows(joins.validity_join(facts, dimension, ("k", "code"), "d", ["v"], bucket_days=days)) == rows(plain)


def test_stretches_make_rows_in_proportion_to_matches(spark):
    """A key with 3000 one-day versions and 3000 facts meets about as many pairs as there are facts."""
    start = F.lit("2015-01-01").cast("date")
    day = F.date_add(start, F.col("id").cast("int"))
    dimension = spark.range(3000).select(F.lit("hot").alias("code"), F.col("id").alias("v"), day.alias("valid_from_date"), day.alias("valid_to_date"))
    facts = spark.range(3000).select(F.lit("hot").alias("k"), day.alias("d"))
    joined = joins.validity_join(facts, dimension, ("k", "code"), "d", ["v"], bucket_days=4)
    assert joined.filter("v IS NOT NULL").count() == 3000
    plan = final_plan(joined)
    assert "_stretch" in plan and "NestedLoop" not in plan
    pairs = facts.withColumn("s", F.floor(F.unix_date("d") / 4)).join(dimension.withColumn("s", F.floor(F.unix_date("valid_from_date") / 4)), "s")
    assert pairs.count() <= 4 * 3000


def test_versions_open_close_and_split(spark):
    schema = "k string, name string, valid_from_date date"
    day = lambda m, d=1: date(2024, m, d)
    load = lambda data: spark.createDataFrame(data, schema)
    merge = lambda held, data: versions.merge_versions(held, load(data), ["k"], ["name"])
    first = merge(None, [("p", "one", None), ("p", "two", day(3)), ("p", "two", day(5)), ("q", "solo", day(1))])
    assert rows(first) == [("p", "one", None, day(2, 29)), ("p", "two", day(3), None), ("q", "solo", day(1), None)]
    late = merge(first, [("p", "late", day(2)), ("p", "three", day(6)), ("r", None, None)])
    assert rows(late, "k", "valid_from_date") == [
        ("p", "one", None, day(1, 31)), ("p", "late", day(2), day(2, 29)), ("p", "two", day(3), day(5, 31)), ("p", "three", day(6), None),
        ("q", "solo", day(1), None), ("r", None, None, None),
    ]
    # a correction of a start, and a change to what is valid anyway
    last = merge(late, [("p", "one", day(2)), ("p", "three", day(7)), ("q", "solo", day(9))])
    assert rows(last, "k", "valid_from_date") == [
        ("p", "one", None, day(2, 29)), ("p", "two", day(3), day(5, 31)), ("p", "three", day(6), None),
        ("q", "solo", day(1), None), ("r", None, None, None),
    ]
    assert rows(versions.merge_versions(last, load([]), ["k"], ["name"])) == rows(last)


def test_prior_period_is_an_equi_join(spark):
    df = spark.createDataFrame([("a", 1, 2023, 5.0), ("a", 1, 2024, 8.0)], "k string, m int, y int, v double")
    joined = joins.prior_period_join(df, ["k", "m"], "y", ["v"], prefix="last_")
    assert rows(joined.select("y", "v", "last_v")) == [(2023, 5.0, None), (2024, 8.0, 5.0)]
    assert "NestedLoop" not in physical_plan(joined)


def test_bridge_needs_pair_state_and_coordinates(spark):
    locations = spark.createDataFrame(
        [
            ("A", "a", "S", "Balancing Authority", "Auth", None),
            ("1", "w1", "S", "Weather Station", "Good", 1.0),
            ("2", "w2", "S", "Weather Station", "No place", None),
            ("3", "w3", "T", "Weather Station", "Elsewhere", 1.0),
        ],
        "location_id string, location_code string, state_name string, location_type string, city string, latitude double",
    ).withColumn("longitude", F.col("latitude"))
    pairs = spark.createDataFrame(
        [("a", "Good"), ("a", "No place"), ("a", "Elsewhere")], "ba_code string, weather_station_name string"
    )
    bridge = joins.build_bridge(locations, pairs)
    assert rows(bridge.select("ba_code", "weather_station_id")) == [("a", "1")]
    plan = physical_plan(bridge)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_anti_join_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    held = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(joins.drop_existing(df, held, ["k"])) == [(None, "b")]
    assert joins.drop_existing(df, held, ["k"], null_safe=True).count() == 0


def test_changes_and_trailing_mean(spark):
    df = spark.createDataFrame([(1, 100.0), (2, 110.0), (3, 0.0), (4, 50.0)], "t int, v double")
    w = Window.orderBy("t")
    got = df.select("t", F.round(series.pct_change("v", w), 6).alias("p"), series.delta("v", w).alias("d"))
    assert [r.p for r in got.orderBy("t").collect()] == [None, 10.0, -100.0, None]
    steps = spark.createDataFrame([(i, float(i)) for i in (1, 2, 3, 4)], "t int, v double")
    got = steps.select("t", series.trailing_mean("v", w, 3).alias("m"), series.offset_mean("v", w, 2, 1).alias("o"))
    assert [(r.m, r.o) for r in got.orderBy("t").collect()] == [(1.0, None), (1.5, 1.0), (2.0, 1.5), (3.0, 2.5)]


@PROPERTY
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 120)), min_size=1, max_size=90, unique=True), st.integers(1, 9))
def test_sliced_equals_one_window_per_series(spark, keys, reach):
    df = spark.createDataFrame([(k, t, float((t * 7) % 11)) for k, t in keys], "k string, t int, v double")

    def columns(w):
        return {"back": F.lag("v", reach).over(w), "mean": F.round(series.trailing_mean("v", w, reach + 1), 9)}

    plain = df.withColumns(columns(Window.partitionBy("k").orderBy("t")))
    cut = series.sliced(df, ["k"], "t", F.floor(F.col("t") / 10), reach, columns)
    assert rows(cut) == rows(plain)


def test_sliced_shuffles_the_series_once(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id", F.col("id").cast("double").alias("v"))
    cut = series.sliced(
        df.repartition(4, "id"), ["k"], "id", F.floor(F.col("id") / 100), 1, lambda w: {"d": series.delta("v", w)}
    )
    plan = final_plan(cut)
    assert "ReusedExchange" in plan[: plan.index("Initial Plan")]


def _ranks(frame):
    out = []
    for _, group in frame.groupby("g", dropna=False):
        v = group.v
        key = v.map(lambda x: (pd.isna(x), 0.0 if pd.isna(x) else x))
        total = len(group)
        for x in key:
            out.append(0.0 if total == 1 else sum(y < x for y in key) / (total - 1))
    return sorted(round(r, 9) for r in out)


@PROPERTY
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["hot", "hot", "hot", "cold", None]),
            st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False), st.sampled_from([0.0, -0.0, 7.0, 7.01])),
        ),
        min_size=1,
        max_size=60,
    ),
)
def test_percent_rank_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "g string, v double")
    got = ranks.percent_rank_by(df, ["g"], "v", "r")
    assert got.count() == len(data)
    assert sorted(round(r.r, 9) for r in got.collect()) == _ranks(pd.DataFrame(data, columns=["g", "v"]))


@PROPERTY
@given(
    st.lists(
        st.tuples(st.sampled_from("aab"), st.one_of(st.none(), st.floats(-1e4, 1e4, allow_nan=False))),
        min_size=1,
        max_size=50,
    )
)
def test_exact_percentiles_against_numpy(spark, data):
    df = spark.createDataFrame(data, "g string, v double")
    got = {
        r.g: (r.low, r.mid, r.high)
        for r in ranks.group_percentiles(df, ["g"], "v", {"low": 0.1, "mid": 0.5, "high": 0.95}).collect()
    }
    expected = {}
    for g in "ab":
        group = [v for k, v in data if k == g and v is not None]
        if group:
            expected[g] = tuple(np.percentile(group, [10, 50, 95]))
    assert got.keys() == expected.keys()
    for g, triple in expected.items():
        assert got[g] == pytest.approx(triple, abs=1e-6)


def test_close_values_of_one_group_spread_over_all_tasks(spark):
    """One group with all rows, all values within 1 % of each other: every range holds about as many of them."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select(F.lit("only").alias("g"), (1000 + (F.col("id") * 7919 % 20_011) / 2001).alias("v"))
        ranged = ranks.value_ranges(df.groupBy("g", "v").agg(F.count("*").alias("n")), ["g"], "v")
        sizes = [r[1] for r in ranged.groupBy("_range").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
        got = ranks.percent_rank_by(df, ["g"], "v", "r").agg(F.min("r"), F.max("r"), F.countDistinct("r")).first()
        assert tuple(got) == (0.0, 1.0, 20_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_weighted_ranks_equal_repeated_rows(spark):
    data = [("a", 1.0, 3), ("a", 2.0, 1), ("a", 2.0, 2), ("a", None, 2), (None, 5.0, 4), ("b", 9.0, 1)]
    df = spark.createDataFrame(data, "g string, v double, n long")
    repeated = df.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    weighted = ranks.percent_ranks(df, ["g"], "v", "r", "n")
    assert rows(weighted) == rows(ranks.percent_ranks(repeated, ["g"], "v", "r"))


def test_bridge_gives_each_fact_its_first_reading_once(spark):
    facts = spark.createDataFrame([("A", 1, 10.0), ("A", 2, 11.0), ("B", 1, 12.0), (None, 1, 13.0)], "location_id string, h int, d double")
    bridge = spark.createDataFrame([("A", "s"), ("A", "t"), ("C", "s")], "balancing_authority_id string, weather_station_id string")
    data = [("s", 1, 5, 1.0), ("t", 1, 4, 2.0), ("t", 1, 6, 3.0), ("u", 1, 1, 4.0), ("s", 3, 1, 5.0)]
    other = spark.createDataFrame(data, "location_id string, h int, at int, temp double")
    for few in (False, True):
        got = joins.bridge_first(facts, bridge, other, ["h"], ["at"], ["temp"], few=few)
        assert rows(got, "d") == [("A", 1, 10.0, 2.0, 3), ("A", 2, 11.0, None, 1), ("B", 1, 12.0, None, 1), (None, 1, 13.0, None, 1)]


def test_approximate_percentile_returns_a_value_that_occurs(spark):
    df = spark.range(10).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v"))
    assert values(ranks.group_percentiles(df, ["g"], "v", {"p": 0.9}, exact=False), "p") == (8.0,)
    assert values(ranks.group_percentiles(df, ["g"], "v", {"p": 0.9}), F.round("p", 6)) == (8.1,)


def test_state_changes(spark):
    data = [("a", f"2024-01-01 0{i}:00:00", s) for i, s in enumerate(["LOW", "LOW", "HIGH", "HIGH", "LOW"])]
    df = spark.createDataFrame(data, "k string, s string, state string").select(
        "k", F.col("s").cast("timestamp_ntz").alias("t"), "state"
    )
    got = states.state_changes(df, ["k"], "t", "state", F.trunc(F.to_date("t"), "month"))
    assert rows(
        got.select("from_state", "to_state", "previous_state_duration_minutes", "from_state_total_minutes"), "from_state"
    ) == [("HIGH", "LOW", 60, 120), ("LOW", "HIGH", 60, None)]


def test_trigger_rules_in_order(spark):
    data = [
        (6, "LOW", "PEAK", False, None, "MORNING_RAMP"),
        (18, "HIGH", "CRITICAL", True, 40.0, "EVENING_PEAK"),
        (12, "PEAK", "NORMAL", True, None, "WEEKEND_REDUCTION"),
        (12, "HIGH", "PEAK", False, -1.0, "EXTREME_TEMPERATURE"),
        (12, "HIGH", "PEAK", False, None, "NORMAL_FLUCTUATION"),
    ]
    df = spark.createDataFrame(data, "h int, f string, t string, w boolean, c double, want string")
    got = df.select(states.classify_trigger("h", "f", "t", "w", "c").alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_missing_value_takes_the_lowest_state(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(1, 101)] + [("a", None)], "k string, v double")
    marked = states.classify_by_thresholds(df, states.state_thresholds(df, ["k"], "v"), ["k"], "v", "s")
    counts = {r.s: r["count"] for r in marked.groupBy("s").count().collect()}
    assert counts == {"CRITICAL": 5, "PEAK": 10, "HIGH": 35, "NORMAL": 25, "LOW": 26}


def test_decompose_rules(spark):
    df = spark.createDataFrame(
        [(100.0, 20.0, 10.0, 2.0, True, 80.0, 90.0), (0.0, None, 10.0, 2.0, False, None, 90.0), (100.0, 1.0, 1.0, None, True, None, 90.0)],
        "d double, t double, mt double, s double, w boolean, wd double, sm double",
    )
    got = df.select(*[c.alias(n) for n, c in stats.decompose("d", "t", "mt", "s", "w", "wd", "sm").items()]).collect()
    assert (got[0].weather_contribution_mwh, got[0].weekend_contribution_mwh, got[0].time_of_day_contribution_mwh) == (20.0, 20.0, 10.0)
    assert got[0].unexplained_demand_mwh == 50.0 and got[0].primary_driver == "TIME_OF_DAY"
    assert got[1].weather_contribution_mwh == 0.0 and got[1].unexplained_demand_mwh == 0.0
    assert got[2].weekend_contribution_mwh is None and got[2].unexplained_demand_mwh is None


def test_upsert_and_insert_only(spark):
    target = spark.createDataFrame([("a", 1), (None, 7)], "k string, v int")
    updates = spark.createDataFrame([("a", 2), ("b", 3), (None, 8)], "k string, v int")
    assert rows(upsert.upsert(target, updates, ["k"])) == [(None, 8), ("a", 2), ("b", 3)]
    named = updates.filter("k IS NOT NULL")
    assert rows(upsert.insert_only(target.filter("k IS NOT NULL"), named, ["k"])) == [("a", 1), ("b", 3)]


def test_schema_changes(spark):
    target = spark.createDataFrame([("a", 1, "x")], "k string, v int, old string")
    updates = spark.createDataFrame([("b", 2, True)], "k string, v int, new boolean")
    assert rows(upsert.upsert(target, updates, ["k"], "append")) == [("a", 1, "x", None), ("b", 2, None, True)]
    assert rows(upsert.upsert(target, updates, ["k"], "sync")) == [("a", 1, None), ("b", 2, True)]
    assert rows(upsert.upsert(target, updates, ["k"], "ignore")) == [("a", 1, "x"), ("b", 2, None)]
    with pytest.raises(ValueError):
        upsert.upsert(target, updates, ["k"], "fail")


@PROPERTY
@given(
    st.dictionaries(st.tuples(st.sampled_from("ab"), st.integers(0, 30)), st.integers(0, 9), min_size=1, max_size=30),
    st.dictionaries(st.tuples(st.sampled_from("abc"), st.integers(0, 30)), st.integers(0, 9), min_size=1, max_size=10),
    st.integers(1, 4),
    st.booleans(),
    st.booleans(),
)
def test_rewriting_what_is_reached_equals_deriving_all(spark, held, fresh, reach, cut, grouped):
    def table(data):
        rows = [("x", k, t, float(v), t // 4) for (k, t), v in data.items()]
        return spark.createDataFrame(rows, "place string, k string, t int, v double, part int")

    def derive(df):
        w = Window.partitionBy("k").orderBy("t")
        columns = {"back": F.lag("v", reach).over(w), "mean": F.round(series.trailing_mean("v", w, reach + 1), 9)}
        if grouped:  # a group that crosses series
            columns["total"] = F.sum("v").over(Window.partitionBy("t"))
        return df.withColumns(columns)

    target = derive(table(held))
    group, mates = (["t"], ["place"]) if grouped else ([], [])
    changes = upsert.rewrite_reached(
        target, table(fresh), ["k", "t"], ["place", "k"], "t", "part", reach, derive, group, mates=mates,
        cut=F.col("part") if cut else None,
    )
    merged = upsert.upsert(target, changes, ["k", "t"])
    assert rows(merged.select(*target.columns)) == rows(derive(table(held | fresh)))
    if not grouped:
        assert changes.count() <= len(fresh) * (reach + 1)


def test_needed_partitions_come_from_counts(spark):
    counts = spark.createDataFrame([("a", m, 10) for m in range(12)] + [("b", 5, 1)], "k string, m int, rows_held long")
    changed = spark.createDataFrame([("a", 6), ("a", 20)], "k string, m int")
    found = lambda reach: rows(upsert.reached_partitions(counts, changed, ["k"], "m", reach))
    assert found(1) == [("a", m) for m in (5, 6, 7, 11, 20)]
    assert found(11) == [("a", m) for m in (4, 5, 6, 7, 8, 10, 11, 20)]


def test_one_late_row_opens_its_partitions_only(spark, tmp_path):
    path = tmp_path / "t"
    hours = spark.range(720 * 6).filter("id <> 1000").select(
        F.lit("s").alias("k"), F.col("id").alias("t"), (F.col("id") % 7).cast("double").alias("v"), F.floor(F.col("id") / 720).cast("int").alias("part")
    )
    derive = lambda df: df.withColumn("change", series.delta("v", Window.partitionBy("k").orderBy("t")))
    derive(hours).write.partitionBy("part").parquet(str(path))
    target = spark.read.parquet(str(path))
    counts = upsert.partition_counts(target, ["k"], "part")
    assert "v:double" not in physical_plan(counts)
    late = spark.createDataFrame([("s", 1000, 5.0, 1)], "k string, t long, v double, part int")
    changes = upsert.rewrite_reached(target, late, ["k", "t"], ["k"], "t", "part", 1, derive, counts=counts)
    opened = re.findall(r"PartitionFilters: \[[^\]]*IN \(([0-9,]+)\)", physical_plan(changes))
    assert opened and {*map(int, opened[0].split(","))} == {0, 1, 2}
    assert rows(changes.select("t", "change")) == [(1000, 5.0 - 999 % 7), (1001, 1001 % 7 - 5.0)]
    files = lambda: {f.name: {x.name for x in f.iterdir()} for f in path.iterdir() if f.is_dir()}
    before = files()
    tables.merge_partitions(changes, str(path), ["k", "t"], "part")
    after = files()
    assert [name for name in sorted(before) if before[name] != after[name]] == ["part=1"]
    assert spark.read.parquet(str(path)).count() == 720 * 6


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "z"), (None, None), (None, "a")], "k int, v string")
    parent = spark.createDataFrame([("a",)], "v string")
    assert rows(quality.violations_unique(df, ["k"])) == [(1, 2)]
    assert quality.violations_not_null(df, "k").count() == 2
    assert rows(quality.violations_accepted(df, "v", ["a"])) == [(1, "z")]
    assert rows(quality.violations_fk(df, "v", parent, "v").select("v")) == [("z",)]
    counted = quality.run_checks("m", df, ["k"], {"v": ["a"]}, ["k"], [("v", parent, "v")])
    assert rows(counted.select("check", "violations")) == [
        ("accepted_values", 1), ("not_null", 2), ("relationships", 1), ("unique", 1),
    ]
