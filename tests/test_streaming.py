import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gridtide.plans import dimensions, grid_states, staging
from gridtide.sources import tables
from gridtide.streaming import capture, ingest

from .helpers import rows


def _land(folder, name, authority, period, value):
    body = {"response": {"data": [{"period": period, "value": value, "value-units": "MWh"}]}}
    (folder / f"demand_{authority}_{name}.json").write_text(json.dumps(body))


def _run(spark, landing, base):
    stream = ingest.stream_landed_json(
        spark, str(landing), r"demand_([A-Z]+)_", ("balancing_authority",), files_per_batch=1
    )
    query = ingest.ingest(
        stream,
        lambda batch: staging.stage_demand(batch).withColumn("month", F.trunc("date", "month")),
        f"{base}/table",
        f"{base}/checkpoint",
        ["balancing_authority", "timestamp"],
        ["source_uploaded_at", "source_id"],
        ["month"],
    )
    query.awaitTermination()
    return ingest.stored_table(spark, f"{base}/table")


def test_only_new_files_are_processed_and_revisions_win(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    assert ingest.stored_table(spark, str(tmp_path / "table")) is None
    _land(landing, "1", "DUK", "2024-01-01T05", "1")
    _land(landing, "2", "DUK", "2024-02-01T05", "2")
    first = _run(spark, landing, tmp_path)
    assert rows(first.select("demand_mwh")) == [(1.0,), (2.0,)]
    untouched = set((tmp_path / "table" / "month=2024-01-01").iterdir())
    _land(landing, "3", "DUK", "2024-02-01T05", "3")
    _land(landing, "4", "CPLE", "2024-02-01T05", "4")
    second = _run(spark, landing, tmp_path)
    assert rows(second.select("balancing_authority", "demand_mwh")) == [("CPLE", 4.0), ("DUK", 1.0), ("DUK", 3.0)]
    assert set((tmp_path / "table" / "month=2024-01-01").iterdir()) == untouched


def test_a_batch_delivered_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([("a", 1, "p"), ("b", 2, "q")], "k string, v int, part string")
    for _ in range(2):
        ingest.merge_into(df, path, ["k"], ["v"], ["part"])
    assert rows(ingest.stored_table(spark, path)) == [("a", 1, "p"), ("b", 2, "q")]


HOURS = "location_id string, balancing_authority string, hour int, mwh double, upload int"
START = "2024-01-01 00:00:00"


def _demand(spark, data):
    """(key, code, hour since the start, MWh, day of upload) as demand facts."""
    start = F.lit(START).cast("timestamp_ntz")
    at = start + F.make_dt_interval(F.lit(0), F.col("hour"))
    return spark.createDataFrame(data, HOURS).select(
        "location_id", "balancing_authority", at.alias("timestamp"), F.date_format(F.to_date(at), "yyyyMMdd").alias("date_id"),
        F.hour(at).alias("hour_of_day"), F.col("mwh").alias("demand_mwh"),
        (start + F.make_dt_interval(F.col("upload"))).alias("source_uploaded_at"), F.col("upload").cast("long").alias("source_id"),
    )


def _surroundings(spark):
    weather = spark.createDataFrame(
        [],
        "date_id string, hour_of_day int, location_id string, station_id string, timestamp timestamp_ntz, "
        "temperature_c double, pressure_hpa double, wind_speed_ms double",
    )
    bridge = spark.createDataFrame([], "balancing_authority_id string, weather_station_id string")
    return weather, dimensions.dim_date(spark, "2024-01-01", 40), bridge


def _day(hour):
    return 100.0 if 17 <= hour % 24 <= 21 else 10.0


def test_runs_equal_one_pass_while_thresholds_stay(spark, tmp_path):
    path = str(tmp_path / "states")
    around = _surroundings(spark)
    keyed = [("A", "a", h, _day(h), 1 + h // 24) for h in range(120)]
    unkeyed = [(None, code, h, _day(h + shift), 1 + h // 24) for code, shift in (("x", 0), ("y", 3)) for h in range(120)]
    every = _demand(spark, keyed + unkeyed)
    assert capture.carried_state(spark, path) is None
    for day in (2, 2, 4, 9):  # the second run has nothing new
        arrived = every.filter(F.col("source_id") <= day)
        capture.capture_states(arrived, path, *around)
        found = capture.captured_changes(spark, path)
        whole = grid_states.grid_state_changes(arrived, *around)
        assert rows(found.select(*whole.columns)) == rows(whole) and found.count() > 0
        assert found.select("state_change_id").distinct().count() == found.count()
    # two authorities without a location key stay two series
    assert found.filter("balancing_authority_id IS NULL").groupBy("balancing_authority").count().count() == 2


def test_late_rows_gaps_and_late_authorities(spark, tmp_path):
    """Held rows keep their states; a late hour changes what is open; one too late and a settled one change nothing."""
    path = str(tmp_path / "states")
    around = _surroundings(spark)
    first = [("A", "a", h, _day(h), 1) for h in range(72) if h not in (40, 60)]
    late = [("A", "a", 60, 100.0, 2), ("A", "a", 40, 100.0, 2), ("A", "a", 100, 100.0, 2), ("B", "b", 5, 1.0, 2), ("B", "b", 6, 9.0, 2)]
    revised = [("A", "a", 100, 1.0, 3), ("A", "a", 3, 100.0, 3)]
    changes = lambda: {
        (r.balancing_authority, (r.state_change_timestamp - datetime.fromisoformat(START)) // timedelta(hours=1)): r
        for r in capture.captured_changes(spark, path).collect()
    }
    capture.capture_states(_demand(spark, first), path, *around)
    before = changes()
    assert sorted(h for _, h in before) == [17, 22, 41, 46, 65, 70]
    capture.capture_states(_demand(spark, first + late), path, *around)
    after = changes()
    assert sorted(after) == [("a", h) for h in (17, 22, 41, 46, 60, 61, 65, 70, 100)] + [("b", 6)]
    assert after["a", 65].from_state_total_minutes == 240 and before["a", 65].from_state_total_minutes == 19 * 60
    assert after["a", 100].previous_state_duration_minutes == 29 * 60 and after["a", 100].from_state_total_minutes == 30 * 60
    newest = [r for r in first + late if r[2] not in (3, 100)] + revised
    capture.capture_states(_demand(spark, newest), path, *around)
    last = changes()
    assert ("a", 100) not in last and ("a", 3) not in last and ("a", 17) in last  # hour 3 was settled long ago
    versions = spark.read.parquet(f"{path}/thresholds")
    assert rows(versions.select("balancing_authority", "version")) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]


def test_a_run_that_failed_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "states")
    around = _surroundings(spark)
    data = [("A", "a", h, _day(h), 1 + h // 24) for h in range(96)]
    capture.capture_states(_demand(spark, data[:48]), path, *around)
    step = grid_states.grid_state_run(_demand(spark, data), *around, capture.carried_state(spark, path))
    step.settled.write.parquet(f"{path}/settled/run=2")  # and then the run failed
    assert capture.captured_changes(spark, path).count() == 4
    capture.capture_states(_demand(spark, data), path, *around)
    assert capture.captured_changes(spark, path).count() == 8 and capture.last_run(spark, path) == 2


def test_view_can_be_queried(spark):
    tables.publish_view(spark.range(3).toDF("x"), "three_rows")
    assert spark.sql("SELECT sum(x) FROM three_rows").first()[0] == 3
