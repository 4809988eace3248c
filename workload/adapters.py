"""Feeds in the landed shapes, made from the given tables. Every row of a table enters its feed.

Demand comes from ``events`` (dense, one month) and ``orders`` (sparse, several years); weather from ``events``
and ``lineitem``; generation from ``lineitem`` with ``part`` and ``supplier``; sales from ``orders`` with
``customer``. Missing values, unreadable times and revisions occur in them, so every rule has work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from gridtide.sources.inline import inline_table

# Fixture tables. Stations: id, latitude, longitude, elevation, name; the stations AO, NF and error stay unknown.
STATIONS = [
    ("click", 35.88, -78.79, 416, "Click International Airport"),
    ("view", 35.21, -80.95, 748, "View Regional Airport"),
    ("purchase", 36.10, -80.44, 925, "Purchase Hill"),
    ("signup", 35.44, -82.54, 2165, "Signup Municipal Airport"),
    ("AF", 34.27, -77.91, 32, "Alpha Airport"),
    ("NO", 36.26, -76.17, 12, "November Point"),
    ("RF", 35.71, -82.49, 2170, "Romeo Mountain"),
    ("RO", 35.90, -80.70, 300, "Oscar Airport"),
]
PAIRS = [
    ("click", "View Regional Airport"),
    ("view", "Purchase Hill"),
    ("purchase", "Click International Airport"),
    ("signup", "Signup Municipal Airport"),
    ("1-URGENT", "Alpha Airport"),
    ("1-URGENT", "November Point"),
    ("2-HIGH", "November Point"),
    ("3-MEDIUM", "Romeo Mountain"),
    ("5-LOW", "Oscar Airport"),
]
POPULATION = [("NATION_1", 10.7), ("click", 1.8), ("1-URGENT", 2.7)]
FUELS = [
    ("ECONOMY", "COW"),
    ("SMALL", "NG"),
    ("STANDARD", "NUC"),
    ("MEDIUM", "SUN"),
    ("PROMO", "WND"),
    ("LARGE", "BIO"),
]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read for the schema only once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def feed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last day of every feed: hourly ones by day, monthly ones by whole months."""
    spans = [
        table(spark, sf_dir, name).agg(F.min(column).alias("first"), F.max(column).alias("last"))
        for name, column in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    every = spans[0].unionByName(spans[1]).unionByName(spans[2])
    first, last = F.trunc("first", "month"), F.last_day("last")
    return every.select(F.explode(F.array(first, last)).alias("date"))


def _at_hour(date: Column, hour: Column) -> Column:
    return F.to_date(date).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _hour_text(date: Column, hour: Column) -> Column:
    return F.concat(F.to_date(date).cast("string"), F.lit("T"), _digits(hour, 2))


def _days_later(timestamp: Column, days: Column | int) -> Column:
    days = F.lit(days) if isinstance(days, int) else days
    return timestamp.cast("timestamp_ntz") + F.make_dt_interval(days)


def _event_k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def _document(**fields: Column) -> Column:
    record = F.struct(*[c.alias(name.replace("__", "-")) for name, c in fields.items()])
    return F.to_json(F.struct(F.struct(F.array(record).alias("data")).alias("response")))


def raw_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, file_name, uploaded_at, data_date, balancing_authority, raw_data`` (JSON text)."""
    k, cents = _event_k(), F.floor(F.col("value") * 100.0)
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("events-"), "event_type", F.lit(".json")).alias("file_name"),
        F.col("ts").alias("uploaded_at"),
        F.to_date("ts").alias("data_date"),
        F.col("event_type").alias("balancing_authority"),
        F.when(k == 99, "n/a").otherwise(_hour_text(F.col("ts"), F.hour("ts"))).alias("period"),
        F.when(k < 3, F.lit(None)).when(F.col("event_type") == "error", -cents).otherwise(cents).alias("value"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("orders-"), "o_orderstatus", F.lit(".json")).alias("file_name"),
        _days_later(F.col("o_orderdate"), 1).alias("uploaded_at"),
        F.to_date("o_orderdate").alias("data_date"),
        F.col("o_orderpriority").alias("balancing_authority"),
        _hour_text(F.col("o_orderdate"), F.col("o_custkey") % 24).alias("period"),
        F.floor("o_totalprice").alias("value"),
    )
    document = _document(
        period=F.col("period"), value=F.col("value").cast("string"), value__units=F.lit("megawatthours")
    )
    return events.unionByName(orders).withColumn("raw_data", document).drop("period", "value")


#: Documents that arrive late: all of one authority; some hours of another by less than a day; four days of a third so
#: late that no run takes them for its states, which leaves a gap.
LATE_AUTHORITY, LATE_HOURS, GAP = "purchase", ("view", (3, 4, 11)), ("click", "2024-01-10", "2024-01-13")


def arriving_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_demand`` with the upload times of documents that arrive late."""
    place, hour = F.col("balancing_authority"), F.hour("uploaded_at")
    delay = (
        F.when(place == LATE_AUTHORITY, F.make_dt_interval(F.lit(13)))
        .when((place == LATE_HOURS[0]) & hour.isin(list(LATE_HOURS[1])), F.make_dt_interval(F.lit(0), F.lit(20)))
        .when((place == GAP[0]) & F.col("data_date").between(GAP[1], GAP[2]), F.make_dt_interval(F.lit(40)))
        .otherwise(F.make_dt_interval(F.lit(0)))
    )
    return raw_demand(spark, sf_dir).withColumn("uploaded_at", F.col("uploaded_at") + delay)


#: Years whose place changes come with the second load: one of them late, between years that are held.
LATE_YEARS = (1997, 2000, 2001)


def place_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``location_code, city, valid_from_date, load``: from each year on, a priority is named after its most frequent
    order status in that year; so names change, stay, and change back."""
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("location_code"), F.year("o_orderdate").alias("year"), "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = counts.groupBy("location_code", "year").agg(F.max_by("o_orderstatus", F.struct("n", "o_orderstatus")).alias("status"))
    return named.select(
        "location_code",
        F.concat_ws(" ", "location_code", "status").alias("city"),
        F.make_date("year", F.lit(1), F.lit(1)).alias("valid_from_date"),
        F.when(F.col("year").isin(list(LATE_YEARS)), 2).otherwise(1).alias("load"),
    )


def price_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``priority, price, valid_from_date, valid_to_date``: a version from each day with orders to the day before the
    next such day; thousands of versions for each of five keys, the last one open."""
    days = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("priority"), F.to_date("o_orderdate").alias("valid_from_date")
    ).agg(F.max("o_totalprice").alias("price"))
    after = F.lead("valid_from_date").over(Window.partitionBy("priority").orderBy("valid_from_date"))
    return days.withColumn("valid_to_date", F.date_sub(after, 1))


def weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat weather readings before they become documents."""
    k = _event_k()
    cycle = F.floor((F.col("value") % 50.0) * 10.0) / 10.0 - 10.0
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("weather-"), "event_type", F.lit(".json")).alias("file_name"),
        F.col("ts").alias("uploaded_at"),
        F.col("event_type").alias("station_id"),
        _at_hour(F.col("ts"), F.hour("ts")).alias("timestamp"),
        F.when(k >= 2, cycle).alias("temperature"),
        (F.lit(5.0) - k % 7).alias("dew_point"),
        F.when(k % 11 != 0, k % 60 + 980.5).alias("pressure"),
        ((k % 20) / 2.0).alias("wind"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("weather-"), "l_returnflag", F.lit(".json")).alias("file_name"),
        _days_later(F.col("l_shipdate"), 1).alias("uploaded_at"),
        F.concat("l_returnflag", "l_linestatus").alias("station_id"),
        _at_hour(F.col("l_shipdate"), F.col("l_partkey") % 24).alias("timestamp"),
        (F.col("l_quantity") - 12.0).alias("temperature"),
        (F.col("l_linenumber") * 1.0).alias("dew_point"),
        (F.col("l_linenumber") + 990.0).alias("pressure"),
        (F.col("l_discount") * 100.0).alias("wind"),
    )
    return events.unionByName(lines)


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, file_name, uploaded_at, station_id, year, raw_data`` (JSON text, an array of readings)."""
    stamp = F.concat(_hour_text(F.col("timestamp"), F.hour("timestamp")), F.lit(":00:00Z"))
    reading = F.struct(
        stamp.alias("timestamp"),
        F.col("temperature").alias("air_temp_celsius"),
        F.col("dew_point").alias("dew_point_celsius"),
        F.col("pressure").alias("sea_level_pressure_hpa"),
        F.col("wind").alias("wind_speed_mps"),
    )
    record = F.struct(F.col("station_id").alias("station"), stamp.alias("timestamp"), reading.alias("raw_data"))
    return weather_readings(spark, sf_dir).select(
        "id",
        "file_name",
        "uploaded_at",
        "station_id",
        F.year("timestamp").alias("year"),
        F.to_json(F.array(record)).alias("raw_data"),
    )


def _version(flag: str, order: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*[F.lit(v) for v in order]), F.col(flag)).cast("long")


def raw_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, file_name, uploaded_at, data_date, raw_data``; a month is revised up to twice."""
    fuels = inline_table(spark, FUELS, "p_type string, fuel string")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type").join(fuels, "p_type")
    places = (
        table(spark, sf_dir, "supplier")
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        .join(table(spark, sf_dir, "nation"), "n_nationkey")
        .select("l_suppkey", "n_name")
    )
    month = F.trunc(F.to_date("l_shipdate"), "month")
    sums = (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_partkey", "l_suppkey", "l_linestatus", "l_returnflag", "l_quantity", month.alias("month")
        )
        .join(parts, "l_partkey")
        .join(places, "l_suppkey")
        .groupBy("month", "n_name", "p_type", "fuel", "l_linestatus", "l_returnflag")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    version = _version("l_returnflag", ("A", "N", "R"))
    unit = F.when(F.col("l_linestatus") == "F", "thousand megawatthours").otherwise("megawatthours")
    document = _document(
        period=F.date_format("month", "yyyy-MM"),
        location=F.col("n_name"),
        stateDescription=F.concat(F.lit("State "), "n_name"),
        fueltypeid=F.col("fuel"),
        fuelTypeDescription=F.lower("p_type"),
        sectorid=F.col("l_linestatus"),
        sectorDescription=F.concat(F.lit("Sector "), "l_linestatus"),
        generation=F.when(F.col("quantity") >= 4, F.col("quantity").cast("string")),
        generation__units=unit,
    )
    uploaded = _days_later(F.add_months("month", 1), version.cast("int"))
    return sums.select(
        version.alias("id"),
        F.concat(F.lit("generation-"), "l_returnflag", F.lit(".json")).alias("file_name"),
        uploaded.alias("uploaded_at"),
        F.to_date(uploaded).alias("data_date"),
        document.alias("raw_data"),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, file_name, uploaded_at, data_date, raw_data``; a month is revised up to twice."""
    customers = (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
        .join(table(spark, sf_dir, "nation"), "n_nationkey")
        .select("o_custkey", "c_mktsegment", "n_name")
    )
    month = F.trunc(F.to_date("o_orderdate"), "month")
    sums = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", "o_orderstatus", "o_totalprice", month.alias("month"))
        .join(customers, "o_custkey")
        .groupBy("month", "n_name", "c_mktsegment", "o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("sales"),
            F.round(F.sum("o_totalprice"), 2).alias("revenue"),
            F.countDistinct("o_custkey").alias("customers"),
        )
    )
    version = _version("o_orderstatus", ("F", "O", "P"))
    document = _document(
        period=F.date_format("month", "yyyy-MM"),
        stateid=F.col("n_name"),
        stateDescription=F.concat(F.lit("State "), "n_name"),
        sectorid=F.substring("c_mktsegment", 1, 3),
        sectorName=F.col("c_mktsegment"),
        sales=F.col("sales").cast("string"),
        revenue=F.col("revenue").cast("string"),
        price=(F.col("revenue") / F.col("sales")).cast("string"),
        customers=F.col("customers").cast("string"),
    )
    uploaded = _days_later(F.add_months("month", 1), version.cast("int"))
    return sums.select(
        version.alias("id"),
        F.concat(F.lit("sales-"), "o_orderstatus", F.lit(".json")).alias("file_name"),
        uploaded.alias("uploaded_at"),
        F.to_date(uploaded).alias("data_date"),
        document.alias("raw_data"),
    )


def isd_lines(spark: SparkSession, sf_dir: str, flawed: bool = False) -> DataFrame:
    """The weather readings as fixed-width lines (tenths, sentinels for missing values); wind in its second place
    for odd hours, so that the parser has to look for it.

    ``flawed`` adds ``id``, puts wind in its third place for every third hour, and spoils some lines by their id: cut
    short, or with an unreadable date, temperature, dew point, pressure, or date and pressure.
    """

    def field(column: str, missing: str) -> Column:
        tenths = F.round(F.col(column) * 10.0).cast("int")
        if missing.startswith("+"):
            text = F.concat(F.when(tenths < 0, "-").otherwise("+"), _digits(F.abs(tenths), 4))
        else:
            text = _digits(tenths, 5)
        return F.coalesce(text, F.lit(missing))

    wind = _digits(F.round(F.col("wind") * 10.0).cast("int"), 5)
    hour = F.hour("timestamp")
    first, second, third = (F.concat(F.lit("x" * n), "wind", F.lit("x" * (8 - n))) for n in (4, 0, 8))
    if flawed:
        places = F.when(hour % 3 == 0, first).when(hour % 3 == 1, second).otherwise(third)
    else:
        places = F.when(hour % 2 == 1, second).otherwise(first)
    readings = weather_readings(spark, sf_dir).withColumn("wind", wind)
    line = F.concat(
        F.lit("0000"),
        F.rpad("station_id", 6, " "),
        F.lit("ABCDE"),
        F.date_format(F.to_date("timestamp"), "yyyyMMdd"),
        _digits(F.hour("timestamp"), 2),
        F.lit("00"),
        F.repeat(F.lit("x"), F.lit(34)),
        places,
        F.repeat(F.lit("x"), F.lit(13)),
        field("temperature", "+9999"),
        F.lit("1"),
        field("dew_point", "+9999"),
        F.lit("1"),
        field("pressure", "99999"),
        F.lit("1ADD"),
    )
    if not flawed:
        return readings.select(line.alias("value"))
    spoil = lambda text, put, at: F.overlay(text, F.lit(put), at + 1)
    case = F.col("id") % 40
    spoilt = (
        F.when(case == 0, F.substring(line, 1, 100))
        .when(case == 1, spoil(line, "13", 19))
        .when(case == 2, spoil(line, "abcde", 87))
        .when(case == 3, spoil(line, "+0 12", 93))
        .when(case == 4, spoil(line, "1x132", 99))
        .when(case == 5, spoil(spoil(line, "1x132", 99), "3x", 21))
        .otherwise(line)
    )
    return readings.select("id", spoilt.alias("value"))


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file under an exact name, through Spark's own file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()
