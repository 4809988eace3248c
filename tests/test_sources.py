import json
from datetime import datetime

from pyspark.sql import functions as F

from gridtide.functions.numeric import parse_number
from gridtide.sources import inline, isd, landed, tables, watermark

from .helpers import physical_plan, rows


def _doc(*records):
    return json.dumps({"response": {"data": list(records)}}, indent=1)


def test_whole_files_with_lineage_and_tags(spark, tmp_path):
    (tmp_path / "hourly_demand_DUK_1.json").write_text(_doc({"period": "2024-01-01T05", "value": "7", "value-units": "MWh"}))
    (tmp_path / "hourly_demand_CPLE_1.json").write_text(_doc({"period": "2024-01-01T06", "value": 8}))
    (tmp_path / "hourly_demand_NONE_1.json").write_text(_doc())
    docs = landed.read_landed_json(spark, str(tmp_path), r"hourly_demand_([A-Z]+)_", ("authority",))
    assert docs.columns == ["id", "file_name", "uploaded_at", "data_date", "authority", "raw_data"]
    assert docs.count() == 3
    items = landed.explode_payload(landed.parse_payload(docs, landed.DEMAND_PAYLOAD), "raw_data.response.data")
    got = items.select("authority", "item.period", "item.value", F.col("item.value-units").alias("units"))
    assert rows(got) == [("CPLE", "2024-01-01T06", "8", None), ("DUK", "2024-01-01T05", "7", "MWh")]


def test_documents_by_line_keep_the_element_index(spark, tmp_path):
    lines = [_doc({"period": "a"}, {"period": "b"}).replace("\n", ""), _doc({"period": "c"}).replace("\n", "")]
    (tmp_path / "part.txt").write_text("\n".join(lines))
    docs = landed.read_landed_json(spark, str(tmp_path), whole_file=False)
    items = landed.explode_payload(
        landed.parse_payload(docs, landed.DEMAND_PAYLOAD), "raw_data.response.data", with_index=True
    )
    assert rows(items.select("item.period", "item_index")) == [("a", 0), ("b", 1), ("c", 0)]


def test_each_document_is_parsed_once(spark):
    raw = spark.range(3).select(F.col("id").cast("string").alias("raw_data"))
    items = landed.explode_payload(landed.parse_payload(raw, landed.DEMAND_PAYLOAD), "raw_data.response.data")
    plan = physical_plan(items.select("item.period"))
    assert plan.count("from_json") == 1


def test_open_schema_reads_quoted_keys(spark):
    raw = spark.createDataFrame([(_doc({"period": "p", "value": "1.5", "value-units": "MWh"}),), ("not json",)], "raw_data string")
    items = landed.explode_variant(landed.parse_payload(raw, None), "$.response.data")
    got = items.select(
        landed.variant_field("item", "value", "double").alias("v"), landed.variant_field("item", "value-units").alias("u")
    )
    assert rows(got) == [(1.5, "MWh")]


def test_newest_manifest_in_all_three_layouts(spark, tmp_path):
    def put(name, content):
        (tmp_path / name).write_text(json.dumps(content))

    put("metadata_list_1.json", {"downloaded_files": [{"file": "old.json"}]})
    put("metadata_list_2.json", {"downloaded_files": [{"file": "a.json", "year": 2024}, {"file": "b.json"}]})
    put("metadata_pattern_1.json", {"pattern": "demand_*_9.json", "authorities": ["DUK", "CPLE"]})
    put("metadata_single_1.json", {"file": ""})
    folder = str(tmp_path)
    listed = landed.latest_manifest_files(spark, folder, "metadata_list_", {"list": "downloaded_files", "name": "file"})
    assert rows(listed) == [("a.json",), ("b.json",)]
    filled = landed.latest_manifest_files(spark, folder, "metadata_pattern_", {"pattern": "pattern", "fill": "authorities"})
    assert rows(filled) == [("demand_CPLE_9.json",), ("demand_DUK_9.json",)]
    assert landed.latest_manifest_files(spark, folder, "metadata_single_", {"single": "file"}).count() == 0
    arrived = spark.createDataFrame([("a.json",), ("z.json",)], "file_name string")
    assert rows(landed.keep_listed(arrived, listed)) == [("a.json",)]


def test_only_listed_files_are_opened(spark, tmp_path):
    data, manifests = tmp_path / "data", tmp_path / "manifests"
    for folder in (data / "sub", manifests):
        folder.mkdir(parents=True)
    for name in ("a.json", "b.json", "sub/c.json", "d.json"):
        (data / name).write_text(_doc({"period": name}))
    listing = lambda *names: json.dumps({"downloaded_files": [{"file": n} for n in names]})
    (manifests / "metadata_1.json").write_text(listing("d.json"))
    (manifests / "metadata_2.json").write_text(listing("a.json", "sub/c.json", "absent.json"))
    layout = {"list": "downloaded_files", "name": "file"}
    files = landed.latest_manifest_files(spark, str(manifests), "metadata_", layout)
    docs = landed.read_listed_json(spark, str(data), files)
    assert rows(docs.select("file_name")) == [("a.json",), ("c.json",)]
    assert sorted(f.rsplit("/", 1)[1] for f in docs.inputFiles()) == ["a.json", "c.json"]
    newest = landed.newest_manifest(spark, str(manifests), "metadata_")
    assert [f.rsplit("/", 1)[1] for f in newest.inputFiles()] == ["metadata_2.json"]
    nothing = landed.latest_manifest_files(spark, str(manifests), "other_", layout)
    assert landed.read_listed_json(spark, str(data), nothing, "x", ("tag",)).columns == [
        "id", "file_name", "uploaded_at", "data_date", "tag", "raw_data"
    ]


def test_lines_have_their_place_in_the_file(spark, tmp_path):
    """Files split over many tasks: every line is numbered once, in order, the same in every read."""
    for name, n in (("a.txt", 500), ("b.txt", 1), ("c.txt", 60)):
        (tmp_path / name).write_text("".join(f"{name} {i} {'x' * (i % 37)}\n" for i in range(n)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key, value in zip(old, ("1000", "100")):
        spark.conf.set(key, value)
    try:
        docs = landed.read_landed_json(spark, str(tmp_path), whole_file=False)
        assert docs.rdd.getNumPartitions() > 5
        for _ in range(2):
            got = docs.select("id", F.split("raw_data", " ")[0].alias("f"), F.split("raw_data", " ")[1].cast("int").alias("i"))
            assert got.filter("id <> i").count() == 0 and got.select("f", "id").distinct().count() == 561
        assert got.filter("f <> 'a.txt'").count() == 61
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def _isd(date="202401310605", wind_61="xxxx", wind_65="00051", wind_69=None, temp="+0123", dew="-0045", pressure="10132"):
    line = "0000" + "723060" + "13722" + date + "x" * 34 + wind_61.ljust(4) + wind_65
    if wind_69 is not None:
        line = line[:69] + wind_69
    return line.ljust(87, "x") + temp + "1" + dew + "1" + pressure + "1ADD"


def test_isd_values_and_sentinels(spark):
    lines = [
        _isd(),
        _isd(temp="+9999", dew="+9999", pressure="99999"),
        _isd(date="202413310605"),  # no such month
        _isd(date="2024013106x5"),  # unreadable
        _isd(temp="  abc"),  # unreadable reading drops the record
        _isd(temp="     "),
        _isd(pressure="     "),  # an empty pressure is only missing
        _isd()[:105],  # too short
        "short",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = isd.parse_isd(df)
    assert got.columns == ["station_id", "timestamp", "temperature_c", "dew_point_c", "pressure_hpa", "wind_speed_ms"]
    at = datetime(2024, 1, 31, 6, 5)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [
            ("723060-13722", at, 12.3, -4.5, 1013.2, 5.1),
            ("723060-13722", at, None, None, None, 5.1),
            ("723060-13722", at, 12.3, -4.5, None, 5.1),
        ],
        key=str,
    )


def test_rejected_lines_name_their_reason(spark):
    lines = [
        (_isd(), None, 0), (_isd()[:105], "short", None), (None, "short", None), (_isd(date="202413310605"), "date", None),
        (_isd(temp="  abc", date="2024013106x5"), "date", None), (_isd(temp="  abc"), "temperature", None), (_isd(dew="+12 4"), "dew_point", None),
        (_isd(pressure="1x132", dew="+9999"), "pressure", None), (_isd(wind_61="0007", wind_65="2xxxx"), None, 1),
        (_isd(wind_65="xxxxx", wind_69="00033"), None, 2), (_isd(wind_65="99999", wind_69="99999"), None, None),
    ]
    df = spark.createDataFrame([(line,) for line, _, _ in lines], "value string")
    judged = isd.judged_isd(df).collect()
    assert [r.reject_reason for r in judged] == [reason for _, reason, _ in lines]
    assert [r.wind_place for r in judged if r.reject_reason is None] == [place for _, reason, place in lines if reason is None]
    assert isd.parse_isd(df).count() == 4


def test_isd_wind_takes_the_first_readable_place(spark):
    lines = [
        _isd(wind_65="99999", wind_69="99999"),
        _isd(wind_61="0007", wind_65="2xxxx"),
        _isd(wind_65="xxxxx", wind_69="00033"),
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert [r.wind_speed_ms for r in isd.parse_isd(df).collect()] == [None, 7.2, 3.3]


def test_isd_documents_round_trip(spark):
    records = isd.parse_isd(spark.createDataFrame([(_isd(),)], "value string"))
    item = landed.explode_payload(landed.parse_payload(isd.isd_documents(records), landed.WEATHER_PAYLOAD), "raw_data")
    assert rows(item.select("item.station", "item.timestamp", "item.raw_data.air_temp_celsius")) == [
        ("723060-13722", "2024-01-31T06:05:00Z", 12.3)
    ]


def test_gzip_text_is_read(spark, tmp_path):
    path = str(tmp_path / "isd")
    spark.createDataFrame([(_isd(),)], "value string").write.option("compression", "gzip").text(path)
    assert isd.parse_isd(isd.read_isd(spark, path)).count() == 1


def test_date_spine_and_inline_tables(spark):
    spine = inline.date_spine(spark, "2022-01-01", 1386)
    assert spine.agg(F.min("date").cast("string"), F.max("date").cast("string"), F.count("date")).first()[:] == (
        "2022-01-01", "2025-10-17", 1386,
    )
    lookup = inline.station_lookup(spark)
    assert lookup.count() == 7
    assert "LocalTableScan" in physical_plan(lookup)


def test_watermark_of_nothing_loads_everything(spark):
    df = spark.createDataFrame([(1,), (5,)], "x int")
    assert watermark.watermark(None, "x", 3) == 3
    assert watermark.watermark(df.limit(0), "x", 3) == 3
    assert watermark.newer_than(df, "x", None).count() == 2
    assert rows(watermark.newer_than(df, "x", df.filter("x = 1"))) == [(5,)]
    assert watermark.table_or_none(spark, "no_such_table") is None
    assert watermark.max_event_time(df.limit(0), "x", 9).first()[0] == 9


def test_partition_refresh_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    tables.refresh_partitions(first, path, ["p"])
    tables.refresh_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    stored = spark.read.parquet(path)
    assert "loaded_at" in stored.columns
    assert rows(stored.select("v", "p")) == [(1, "a"), (9, "b")]
    tables.append_raw(first, path + "_raw")
    tables.append_raw(first, path + "_raw")
    assert spark.read.parquet(path + "_raw").count() == 4
    tables.refresh_table(first, path + "_raw", audit=False)
    assert spark.read.parquet(path + "_raw").count() == 2


def test_unreadable_numbers_do_not_raise(spark):
    df = spark.createDataFrame([("x",)], "t string")
    assert df.select(parse_number(F.col("t"))).first()[0] is None
