"""Registered queries. Each is a function of (session, table folder) over the whole tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtide.functions import calendar as cal, fixed_values as fixed
from gridtide.operators import dedup, joins, quality, ranks, series, stats, upsert, versions
from gridtide.operators.sketches import rank_error
from gridtide.plans import analytics, checks, dimensions, facts, grid_states, reports, staging
from gridtide.sources import inline, isd, landed, watermark
from gridtide.sources.tables import (
    append_raw,
    merge_partitions,
    new_folder,
    publish_view,
    refresh_partitions,
    refresh_table,
    settle,
)
from gridtide.streaming import capture, ingest

from . import adapters

EVENTS_CUT = "2024-01-15 10:30:00"
SALES_CUT = "1999-01-03 00:00:00"


class Models:
    """The models over one table folder, each built when first asked for.

    ``*_table`` members are settled: written once and read by everything that follows, as a warehouse would do
    with its dimension and fact tables.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_demand(self) -> DataFrame:
        return adapters.raw_demand(self.spark, self.sf_dir)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return adapters.raw_weather(self.spark, self.sf_dir)

    @cached_property
    def stage_demand(self) -> DataFrame:
        return staging.stage_demand(self.raw_demand)

    @cached_property
    def stage_demand_table(self) -> DataFrame:
        return settle(self.stage_demand, "stage_demand")

    @cached_property
    def stage_weather(self) -> DataFrame:
        return staging.stage_weather(self.raw_weather)

    @cached_property
    def hourly_weather(self) -> DataFrame:
        return staging.stage_weather(self.raw_weather, per_hour=True)

    @cached_property
    def stage_generation(self) -> DataFrame:
        return staging.stage_generation(adapters.raw_generation(self.spark, self.sf_dir))

    @cached_property
    def stage_generation_table(self) -> DataFrame:
        return settle(self.stage_generation, "generation")

    @cached_property
    def stage_sales(self) -> DataFrame:
        return staging.stage_sales(adapters.raw_sales(self.spark, self.sf_dir), states=None)

    @cached_property
    def station_metadata(self) -> DataFrame:
        known = inline.station_lookup(self.spark, adapters.STATIONS)
        return staging.stage_station_metadata(self.raw_weather, known)

    @cached_property
    def dates(self) -> DataFrame:
        spine = inline.spanning_spine(adapters.feed_dates(self.spark, self.sf_dir), "date")
        return dimensions.describe_dates(spine, as_of="2024-01-15")

    @cached_property
    def energy_sources(self) -> DataFrame:
        return dimensions.dim_energy_source(self.stage_generation_table)

    @cached_property
    def sources_table(self) -> DataFrame:
        return settle(self.energy_sources, "sources")

    @cached_property
    def population(self) -> DataFrame:
        return inline.population(self.spark, adapters.POPULATION)

    @cached_property
    def locations(self) -> DataFrame:
        records = staging.demand_records(self.raw_demand)
        return dimensions.dim_location(self.stage_generation, self.station_metadata, records, self.population)

    def _places(self, places: DataFrame) -> DataFrame:
        return settle(dimensions.describe_places(places, self.population), "locations")

    @cached_property
    def authorities_table(self) -> DataFrame:
        return self._places(dimensions.authority_places(self.stage_demand_table))

    @cached_property
    def stations_table(self) -> DataFrame:
        return self._places(dimensions.station_places(self.station_metadata))

    @cached_property
    def states_table(self) -> DataFrame:
        return self._places(dimensions.state_places(self.stage_generation_table))

    @cached_property
    def bridge_table(self) -> DataFrame:
        places = self.authorities_table.unionByName(self.stations_table)
        pairs = inline.bridge_pairs(self.spark, adapters.PAIRS)
        return settle(dimensions.location_bridge(places, pairs), "bridge")

    @cached_property
    def demand_hours(self) -> DataFrame:
        """The demand fact without its derived column, for models that do not use it."""
        return facts.demand_base(self.stage_demand_table, self.authorities_table)

    @cached_property
    def fact_demand(self) -> DataFrame:
        return facts.demand_changes(self.demand_hours)

    @cached_property
    def weather_hours(self) -> DataFrame:
        """The weather fact without its derived columns."""
        return facts.weather_base(self.hourly_weather, self.stations_table, hourly=True)

    @cached_property
    def weather_hours_table(self) -> DataFrame:
        return settle(self.weather_hours, "weather")

    @cached_property
    def fact_weather(self) -> DataFrame:
        return facts.weather_changes(self.weather_hours)

    @cached_property
    def fact_generation(self) -> DataFrame:
        return facts.fact_generation(self.stage_generation_table, self.sources_table, self.states_table)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(self.stage_sales, self.states_table)

    @cached_property
    def monthly_generation(self) -> DataFrame:
        return settle(
            analytics.monthly_generation(self.fact_generation, self.dates, self.sources_table), "monthly"
        )

    @cached_property
    def correlation(self) -> DataFrame:
        daily = analytics.daily_demand_weather(self.demand_hours, self.weather_hours, self.dates, self.bridge_table)
        return analytics.weather_demand_correlation(
            settle(daily, "daily"), self.authorities_table, exact_thresholds=True
        )

    @cached_property
    def peak_drivers(self) -> DataFrame:
        hours = analytics.demand_with_weather(
            self.demand_hours, self.weather_hours_table, self.dates, self.authorities_table, self.bridge_table
        )
        hours = settle(hours, "hours")
        marked = analytics.mark_peaks(hours, self.weather_hours_table)
        return analytics.peak_drivers(marked, settle(analytics.demand_profile(hours), "profile"))

    @cached_property
    def cumulative(self) -> DataFrame:
        return analytics.cumulative_patterns(self.demand_hours, self.dates)

    @cached_property
    def state_changes(self) -> DataFrame:
        return grid_states.grid_state_changes(
            self.demand_hours, self.weather_hours, self.dates, self.bridge_table, self.thresholds_table
        )

    @cached_property
    def thresholds_table(self) -> DataFrame:
        return settle(grid_states.authority_thresholds(self.demand_hours), "thresholds")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison (adding 0.0 turns -0.0 into 0.0)."""
    return df.select(
        *[
            (F.round(F.col(name), digits) + 0.0).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _trailing_avg(m: Models) -> DataFrame:
    """Daily demand per authority from the staged hours, with its trailing seven-day mean."""
    days = stats.daily_rollup(m.stage_demand, ["balancing_authority", "date"], "demand_mwh")
    w = Window.partitionBy("balancing_authority").orderBy("date")
    return days.select(
        "balancing_authority",
        "date",
        F.col("total").alias("daily_demand_mwh"),
        F.col("deviation").alias("daily_demand_variability"),
        series.trailing_mean("total", w, 7).alias("trailing_7d_avg_demand"),
    )


def _observed_calendar(m: Models) -> DataFrame:
    """Calendar attributes of every day from the first to the last landed demand document."""
    return dimensions.describe_dates(inline.spanning_spine(m.raw_demand, "data_date"), as_of="2024-01-15")


def _isd(m: Models) -> DataFrame:
    """Fixed-width records written as gzipped files, read back and parsed."""
    path = new_folder(m.spark, "isd")
    adapters.isd_lines(m.spark, m.sf_dir).write.option("compression", "gzip").text(path)
    return isd.parse_isd(isd.read_isd(m.spark, path))


def _isd_rejects(m: Models) -> DataFrame:
    """Lines of all kinds in one pass: records by the place of their wind, rejected lines by their reason."""
    judged = isd.judged_isd(adapters.isd_lines(m.spark, m.sf_dir, flawed=True))
    place = F.when(F.col("reject_reason").isNull(), F.col("wind_place"))
    return judged.groupBy("reject_reason", place.alias("wind_place")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("reject_reason").isNull(), F.col("temperature_c"))).alias("temperatures"),
        F.sum(F.when(F.col("reject_reason").isNull(), F.col("wind_speed_ms"))).alias("wind_sum"),
    )


def _manifest_load(m: Models) -> DataFrame:
    """Two generations of landed documents, each with a manifest; the newest one names the files that are loaded: not
    those of the first generation, not one authority that landed unlisted, and one file that never arrived."""
    base = new_folder(m.spark, "generations")
    cut = F.lit(EVENTS_CUT).cast("timestamp_ntz")
    documents = m.raw_demand.select("balancing_authority", "uploaded_at", F.col("raw_data").alias("value"))
    early, late = documents.filter(F.col("uploaded_at") < cut), documents.filter(F.col("uploaded_at") >= cut)
    listed_before: set[str] = set()
    for generation, rows in ((1, early), (2, late)):
        rows.drop("uploaded_at").write.mode("append").partitionBy("balancing_authority").text(f"{base}/data")
        names = {r.file_name for r in landed.file_names(m.spark, f"{base}/data", "*.txt").collect()}
        fresh = [n for n in sorted(names - listed_before) if "=error/" not in n]
        listed_before = names
        manifest = {"downloaded_files": [{"file": n} for n in [*fresh, "never_arrived.txt"]]}
        adapters.write_small_text(m.spark, f"{base}/manifests/metadata_{generation}.json", json.dumps(manifest))
    layout = {"list": "downloaded_files", "name": "file"}
    files = landed.latest_manifest_files(m.spark, f"{base}/manifests", "metadata_", layout)
    docs = landed.read_listed_json(
        m.spark, f"{base}/data", files, r"/balancing_authority=([^/]+)/", ("authority",), whole_file=False
    )
    items = landed.explode_payload(landed.parse_payload(docs, landed.DEMAND_PAYLOAD), "raw_data.response.data")
    return items.select(
        F.url_decode("authority").alias("authority"),
        F.col("item.period").alias("period"),
        F.col("item.value").try_cast("double").alias("value"),
    )


def _landed_lines(m: Models) -> DataFrame:
    """Demand staged from files that each hold all documents of an authority, in the order they came: revisions of one
    file share its upload time, and the later line wins."""
    path = new_folder(m.spark, "lines")
    sent = m.raw_demand.select("balancing_authority", "uploaded_at", "id", F.col("raw_data").alias("value"))
    one_file = sent.repartition("balancing_authority").sortWithinPartitions("balancing_authority", "uploaded_at", "id")
    one_file.select("balancing_authority", "value").write.partitionBy("balancing_authority").text(path)
    docs = landed.read_landed_json(
        m.spark, f"{path}/*", r"/balancing_authority=([^/]+)/", ("balancing_authority",), whole_file=False
    )
    docs = docs.withColumn("balancing_authority", F.url_decode("balancing_authority"))
    return staging.stage_demand(docs).select("balancing_authority", "timestamp", "demand_mwh")


def _landed_json(m: Models) -> DataFrame:
    """Documents written as landing files by authority, scanned back with lineage, parsed and unnested."""
    path = new_folder(m.spark, "landing")
    m.raw_demand.select("balancing_authority", F.col("raw_data").alias("value")).write.partitionBy(
        "balancing_authority"
    ).text(path)
    docs = landed.read_landed_json(
        m.spark, f"{path}/*", r"/balancing_authority=([^/]+)/", ("authority",), whole_file=False
    )
    items = landed.explode_payload(
        landed.parse_payload(docs, landed.DEMAND_PAYLOAD), "raw_data.response.data", with_index=True
    )
    return items.select(
        F.url_decode("authority").alias("authority"),
        "item_index",
        F.col("item.period").alias("period"),
        F.col("item.value").try_cast("double").alias("value"),
        F.col("item.value-units").alias("units"),
    )


def _open_payload(m: Models) -> DataFrame:
    """The demand payload read without a schema: variant paths instead of a fixed struct."""
    docs = landed.parse_payload(m.raw_demand, None)
    items = landed.explode_variant(docs, "$.response.data")
    return items.groupBy("balancing_authority", landed.variant_field("item", "value-units").alias("units")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count(landed.variant_field("item", "value", "double")).alias("readings"),
        F.max(landed.variant_field("item", "period")).alias("last_period"),
    )


def _watermark(m: Models) -> DataFrame:
    """Latest event time of the payload of each feed, with the feed's default."""
    demand = landed.explode_payload(landed.parse_payload(m.raw_demand, landed.DEMAND_PAYLOAD), "raw_data.response.data")
    weather = landed.explode_payload(landed.parse_payload(m.raw_weather, landed.WEATHER_PAYLOAD), "raw_data")
    start = F.lit(fixed.DEMAND_FEED_START).cast("timestamp_ntz")
    latest = watermark.max_event_time(demand, cal.to_ntz("item.period")).select(
        F.lit("demand").alias("feed"), F.coalesce("latest", start).alias("latest")
    )
    return latest.unionByName(
        watermark.max_event_time(weather, cal.to_ntz("item.timestamp")).select(F.lit("weather").alias("feed"), "latest")
    )


def _split(m: Models) -> tuple[DataFrame, DataFrame]:
    """Staged demand before and after the cut of the upload time."""
    early = m.raw_demand.filter(F.col("uploaded_at") < F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    late = m.raw_demand.filter(F.col("uploaded_at") >= F.lit(EVENTS_CUT).cast("timestamp_ntz"))
    return staging.stage_demand(early), staging.stage_demand(late)


def _authority_hours(df: DataFrame) -> DataFrame:
    return df.groupBy("balancing_authority", "hour_of_day").agg(
        F.sum("demand_mwh").alias("demand_mwh"), F.max("source_uploaded_at").alias("source_uploaded_at")
    )


def _upsert(m: Models) -> DataFrame:
    early, late = _split(m)
    return upsert.upsert(_authority_hours(early), _authority_hours(late), ["balancing_authority", "hour_of_day"])


def _insert_only(m: Models) -> DataFrame:
    early, late = _split(m)
    return upsert.insert_only(_authority_hours(early), _authority_hours(late), ["balancing_authority", "hour_of_day"])


def _schema_evolution(m: Models) -> DataFrame:
    """Upsert whose updates lack one column and bring another: old rows keep the one, new rows have the other."""
    early, late = _split(m)
    held = _authority_hours(early).withColumn("held_only", F.lit("held"))
    fresh = _authority_hours(late).withColumn("fresh_only", F.lit(1))
    return upsert.upsert(held, fresh, ["balancing_authority", "hour_of_day"], "append")


def _newer_than(m: Models) -> DataFrame:
    """Staged demand beyond the watermark of what was loaded before the cut."""
    early, _ = _split(m)
    return watermark.newer_than(m.stage_demand, "source_uploaded_at", settle(early.select("source_uploaded_at")))


def _two_runs(
    m: Models, first: DataFrame, date: str, hourly: bool, keys: list[str], increment: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """A fact written by its partitions, then merged with the increment that the second run makes of it."""
    path, partition = new_folder(m.spark, "fact"), facts.HOURLY_PARTITION if hourly else facts.MONTHLY_PARTITION
    refresh_partitions(facts.with_partition(first, date, hourly), path, [partition], audit=False)
    merge_partitions(settle(increment(m.spark.read.parquet(path)), "changes"), path, keys, partition)
    return m.spark.read.parquet(path).drop(partition)


def _demand_increment(m: Models) -> DataFrame:
    """The demand fact loaded in two runs, split by upload time: equal to the full refresh."""
    early, _ = _split(m)
    first = facts.fact_demand(early, m.authorities_table)
    increment = lambda held: facts.fact_demand_increment(held, m.stage_demand_table, m.authorities_table)
    return _two_runs(m, first, "date", True, facts.DEMAND_KEYS, increment)


def _weather_increment(m: Models) -> DataFrame:
    """The weather fact loaded in two runs: held hours keep their first reading."""
    cut = F.lit(EVENTS_CUT).cast("timestamp_ntz")
    early = staging.stage_weather(m.raw_weather.filter(F.col("uploaded_at") < cut))
    increment = lambda held: facts.fact_weather_increment(held, m.stage_weather, m.stations_table)
    return _two_runs(m, facts.fact_weather(early, m.stations_table), "date", True, facts.WEATHER_KEYS, increment)


def _sales_increment(m: Models) -> DataFrame:
    """The sales fact loaded in two runs: held months keep their first revision."""
    cut = F.lit(SALES_CUT).cast("timestamp_ntz")
    raw = adapters.raw_sales(m.spark, m.sf_dir)
    early = staging.stage_sales(raw.filter(F.col("uploaded_at") < cut), states=None)
    increment = lambda held: facts.fact_sales_increment(held, m.stage_sales, m.states_table)
    return _two_runs(m, facts.fact_sales(early, m.states_table), "sales_date", False, facts.SALES_KEYS, increment)


def _generation_increment(m: Models) -> DataFrame:
    """The generation fact loaded in two runs: held keys keep their first record."""
    cut = F.lit(SALES_CUT).cast("timestamp_ntz")
    raw = adapters.raw_generation(m.spark, m.sf_dir)
    early = staging.stage_generation(raw.filter(F.col("uploaded_at") < cut))
    first = facts.fact_generation(early, m.sources_table, m.states_table)
    increment = lambda held: facts.fact_generation_increment(
        held, m.stage_generation_table, m.sources_table, m.states_table
    )
    return _two_runs(m, first, "generation_date", False, facts.GENERATION_KEYS, increment)


def _cumulative_increment(m: Models) -> DataFrame:
    """Cumulative patterns after the late demand arrived: equal to the full refresh."""
    early, _ = _split(m)
    before = settle(facts.demand_base(early, m.authorities_table), "before")
    path, partition = new_folder(m.spark, "cumulative"), facts.MONTHLY_PARTITION
    refresh_partitions(analytics.cumulative_table(before, m.dates), path, [partition], audit=False)
    demand = settle(facts.demand_base(m.stage_demand_table, m.authorities_table), "after")
    mark = watermark.watermark(before, "source_uploaded_at")
    changed = demand.filter(F.col("source_uploaded_at") > F.lit(mark).cast("timestamp_ntz"))
    changes = analytics.cumulative_increment(m.spark.read.parquet(path), demand, m.dates, changed)
    merge_partitions(settle(changes, "changes"), path, analytics.CUMULATIVE_KEYS, partition)
    return m.spark.read.parquet(path).drop(partition, "year", "week_of_year")


#: Upload times that end the first two of three runs.
RUN_CUTS = ("2024-01-09 10:30:00", "2024-01-20 06:10:00")


def _runs_of(arriving: DataFrame) -> list[DataFrame]:
    """Documents of each run, by upload time."""
    bounds = [None, *[F.lit(c).cast("timestamp_ntz") for c in RUN_CUTS], None]
    runs = []
    for low, high in zip(bounds, bounds[1:]):
        here = arriving if low is None else arriving.filter(F.col("uploaded_at") >= low)
        runs.append(here if high is None else here.filter(F.col("uploaded_at") < high))
    return runs


def _state_increment(m: Models) -> DataFrame:
    """Grid states in three runs, each over what has arrived by then, with the state that the run before left."""
    runs = _runs_of(adapters.arriving_demand(m.spark, m.sf_dir))
    arrived, carried, settled = None, None, []
    for documents in runs:
        arrived = documents if arrived is None else arrived.unionByName(documents)
        demand = settle(facts.demand_base(staging.stage_demand(arrived), m.authorities_table), "arrived")
        run = grid_states.grid_state_run(demand, m.weather_hours_table, m.dates, m.bridge_table, carried)
        carried = grid_states.Carried(*[settle(df) for df in (run.carried.carry, run.carried.journal, run.carried.open_changes)])
        settled.append(settle(run.settled, "settled"))
    changes = carried.open_changes
    for df in settled:
        changes = changes.unionByName(df)
    return changes


def _captured_states(m: Models) -> DataFrame:
    """The same three runs as a stream: documents land, are merged into the demand table, and states are captured."""
    base = new_folder(m.spark, "capture")
    schema = m.raw_demand.schema.simpleString()
    weather = m.weather_hours_table

    def capture_after_batch() -> None:
        staged = ingest.stored_table(m.spark, f"{base}/table").drop("month")
        demand = facts.demand_base(staged, m.authorities_table)
        capture.capture_states(demand, f"{base}/states", weather, m.dates, m.bridge_table)

    for documents in _runs_of(adapters.arriving_demand(m.spark, m.sf_dir)):
        sent = documents.withColumn("uploaded_at", F.col("uploaded_at").cast("string"))
        sent.select(F.to_json(F.struct(*sent.columns)).alias("value")).write.mode("append").text(f"{base}/landing")
        _ingest_documents(m, base, schema, capture_after_batch).awaitTermination()
    return capture.captured_changes(m.spark, f"{base}/states")


def _ingest_documents(
    m: Models, base: str, schema: str, after: Callable[[], None] | None = None, files_per_batch: int | None = None
) -> StreamingQuery:
    """Merges what has landed in ``base``/landing, one JSON document a line, into ``base``/table."""
    stream = ingest.stream_landed_json(m.spark, f"{base}/landing", whole_file=False, files_per_batch=files_per_batch)
    # JSON keeps milliseconds only, so the upload time travels as text
    text_times = schema.replace("uploaded_at:timestamp_ntz", "uploaded_at:string")
    documents = stream.select(F.from_json("raw_data", text_times).alias("doc")).select("doc.*")
    documents = documents.withColumn("uploaded_at", cal.to_ntz("uploaded_at"))
    return ingest.ingest(
        documents,
        lambda batch: staging.stage_demand(batch).withColumn("month", F.trunc("date", "month")),
        f"{base}/table",
        f"{base}/checkpoint",
        ["balancing_authority", "timestamp"],
        ["source_uploaded_at", "source_id", "demand_mwh"],
        ["month"],
        after,
    )


def _stream_demand(m: Models) -> DataFrame:
    """Documents landed as files and ingested by a file stream into a table partitioned by month."""
    base = new_folder(m.spark, "stream")
    sent = m.raw_demand.withColumn("uploaded_at", F.col("uploaded_at").cast("string"))
    sent.select(F.to_json(F.struct(*sent.columns)).alias("value")).write.text(f"{base}/landing")
    _ingest_documents(m, base, m.raw_demand.schema.simpleString(), files_per_batch=4).awaitTermination()
    return ingest.stored_table(m.spark, f"{base}/table").drop("month")


def _partitioned(m: Models) -> DataFrame:
    """The demand fact written by month and read back, with the rows of each partition."""
    path = new_folder(m.spark, "partitioned")
    refresh_partitions(m.fact_demand.withColumn("month", F.trunc("date", "month")), path, ["month"])
    stored = m.spark.read.parquet(path)
    return stored.groupBy("month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("demand_mwh").alias("demand_mwh"),
        F.count("loaded_at").alias("stamped"),
    )


def _place_history(m: Models) -> DataFrame:
    """The versions of the places after two loads of changes, the second with a late year."""
    changes = settle(adapters.place_changes(m.spark, m.sf_dir), "changes")
    history = None
    for load in (1, 2):
        arrived = changes.filter(F.col("load") == load)
        history = settle(versions.merge_versions(history, arrived, ["location_code"], ["city"]), "history")
    return history


def _validity(m: Models) -> DataFrame:
    """Demand joined to the version of its authority that is valid on the day."""
    joined = joins.validity_join(
        m.stage_demand_table, _place_history(m), ("balancing_authority", "location_code"), "date", ["city"]
    )
    return joined.groupBy("balancing_authority", "city").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("demand_mwh").alias("demand_mwh")
    )


def _validity_many(m: Models) -> DataFrame:
    """Orders joined to the price version of their priority that is valid some days after the order: keys with
    thousands of versions each, met by stretches of days."""
    orders = adapters.table(m.spark, m.sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 40 - 9).cast("int")).alias("day"),
    )
    held = adapters.price_versions(m.spark, m.sf_dir)
    return joins.validity_join(
        orders, held, ("o_orderpriority", "priority"), "day", ["price", "valid_from_date", "valid_to_date"], bucket_days=4
    )


def _percent_rank(m: Models) -> DataFrame:
    ranked = ranks.percent_rank_by(m.stage_demand, ["balancing_authority"], "demand_mwh", "demand_percentile")
    return ranked.select("balancing_authority", "timestamp", "demand_mwh", "demand_percentile")


def _line_quantity_ranks(m: Models) -> DataFrame:
    """Percent rank of every line item by price within its flags: large groups, read straight from the table."""
    lines = adapters.table(m.spark, m.sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_extendedprice")
    ranked = ranks.percent_rank_by(lines, ["l_returnflag"], "l_extendedprice", "price_rank")
    return ranked.groupBy("l_returnflag", "l_orderkey").agg(F.max("price_rank").alias("price_rank"))


STATE_PS = {f"p{int(p * 100)}": p for _, p in fixed.DEMAND_STATES}


def _group_percentiles(m: Models) -> DataFrame:
    return ranks.group_percentiles(m.stage_demand, ["balancing_authority"], "demand_mwh", STATE_PS)


#: Well below the size of the groups, so that the sketches have to leave values out.
APPROX_ACCURACY = 100


def _group_percentiles_approx(m: Models) -> DataFrame:
    """Exact percentiles, and whether the approximate ones occur and have a rank within the error of the sketch."""
    by = ["balancing_authority"]
    rows = m.stage_demand_table.filter("demand_mwh IS NOT NULL").select(*by, "demand_mwh")
    found = ranks.group_percentiles(rows, by, "demand_mwh", STATE_PS, False, APPROX_ACCURACY)
    exact = ranks.group_percentiles(rows, by, "demand_mwh", STATE_PS).unpivot(by, [*STATE_PS], "percentile", "exact")
    return _rank_check(rows, found, by, "demand_mwh", STATE_PS, 1 / APPROX_ACCURACY).join(exact, [*by, "percentile"])


def _rank_check(
    rows: DataFrame, found: DataFrame, by: list[str], value: str, percentiles: dict[str, float], error: float
) -> DataFrame:
    """(``by``, percentile, n, occurs, within): whether the found values occur and are off by two errors at most."""
    long = found.unpivot(by, [*percentiles], "percentile", "_found")
    counts = rows.join(long, by).groupBy(*by, "percentile").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(value) < F.col("_found"), 1)).alias("below"),
        F.count(F.when(F.col(value) <= F.col("_found"), 1)).alias("upto"),
    )
    p = F.create_map(*[F.lit(x) for pair in percentiles.items() for x in pair])[F.col("percentile")]
    slack = 2 * error * F.col("n") + 1
    within = (F.col("below") - slack <= p * F.col("n")) & (p * F.col("n") <= F.col("upto") + slack)
    return counts.select(*by, "percentile", "n", (F.col("upto") > F.col("below")).alias("occurs"), within.alias("within"))


SEASON_PS = analytics.SEASON_THRESHOLDS


def _season_thresholds(m: Models) -> DataFrame:
    """Seasonal temperature thresholds from kept sketches: a first load, then later months and a revised one."""
    path, by = new_folder(m.spark, "sketches"), ["balancing_authority_id", "season"]
    staged = m.hourly_weather.select(F.col("station_id").alias("balancing_authority_id"), "date", "temperature_c")
    seasons = m.dates.select("date", "season")
    hours = settle(staged.join(seasons, "date").withColumnRenamed("temperature_c", "regional_avg_temp_c"), "hours")
    sketches = settle(analytics.season_sketches(hours), "sketches")
    spoilt = analytics.season_sketches(hours.withColumn("regional_avg_temp_c", F.lit(99.0)))
    late, revised = F.col("sketch_month") >= "1999-01-01", F.col("sketch_month") == "1998-07-01"
    first = sketches.filter(~late & ~revised).unionByName(spoilt.filter(revised))
    refresh_partitions(first, path, ["sketch_month"], audit=False)
    refresh_partitions(sketches.filter(late | revised), path, ["sketch_month"], audit=False)
    found = analytics.season_thresholds(m.spark.read.parquet(path))
    rows = hours.filter("regional_avg_temp_c IS NOT NULL")
    exact = ranks.group_percentiles(rows, by, "regional_avg_temp_c", SEASON_PS).unpivot(by, [*SEASON_PS], "percentile", "exact")
    return _rank_check(rows, settle(found), by, "regional_avg_temp_c", SEASON_PS, rank_error()).join(exact, [*by, "percentile"])


def _correlation_default(m: Models) -> DataFrame:
    """The correlation with its default thresholds, which are approximate: all but the zones they decide."""
    daily = analytics.daily_demand_weather(m.demand_hours, m.weather_hours, m.dates, m.bridge_table)
    sketched = analytics.weather_demand_correlation(settle(daily, "daily"), m.authorities_table)
    return sketched.withColumn("has_zone", F.col("temperature_zone").isNotNull()).drop("temperature_zone")


def _first_load(m: Models) -> DataFrame:
    """The first load of the cumulative patterns: the 730 days before a given day, and what follows."""
    return analytics.cumulative_patterns(m.demand_hours, m.dates, as_of="2001-03-01")


def _schema_modes(m: Models) -> DataFrame:
    """An upsert whose updates lack one column and bring another, in the three other modes."""
    early, late = _split(m)
    held = settle(_authority_hours(early).withColumn("held_only", F.lit("held")))
    fresh = settle(_authority_hours(late).withColumn("fresh_only", F.lit(1)))
    key = ["balancing_authority", "hour_of_day"]
    both = []
    for mode in ("sync", "ignore"):
        merged = upsert.upsert(held, fresh, key, mode)
        names = F.array_join(F.sort_array(F.array(*[F.lit(c) for c in merged.columns])), ",")
        both.append(merged.select(F.lit(mode).alias("mode"), *key, "demand_mwh", names.alias("columns")))
    try:
        upsert.upsert(held, fresh, key, "fail")
        refused = "merged"
    except ValueError:
        refused = "refused"
    row = m.spark.range(1).select(
        F.lit("fail").alias("mode"), F.lit(None).cast("string").alias(key[0]), F.lit(None).cast("int").alias(key[1]),
        F.lit(None).cast("double").alias("demand_mwh"), F.lit(refused).alias("columns"),
    )
    return both[0].unionByName(both[1]).unionByName(row)


def _table_writers(m: Models) -> DataFrame:
    """Raw documents appended in two loads, a total table refreshed twice from them, read through a view."""
    base = new_folder(m.spark, "writers")
    cut = F.lit(EVENTS_CUT).cast("timestamp_ntz")
    documents = m.raw_demand.select("id", "balancing_authority", "uploaded_at")
    append_raw(documents.filter(F.col("uploaded_at") < cut), f"{base}/raw")
    for late in (False, True):
        if late:
            append_raw(documents.filter(F.col("uploaded_at") >= cut), f"{base}/raw")
        stored = m.spark.read.parquet(f"{base}/raw")
        totals = stored.groupBy("balancing_authority").agg(
            F.count(F.lit(1)).alias("documents"), F.max("uploaded_at").alias("last_upload")
        )
        refresh_table(totals, f"{base}/totals")
    publish_view(m.spark.read.parquet(f"{base}/totals"), "demand_document_totals")
    return m.spark.table("demand_document_totals").drop("loaded_at")


def _first_run(m: Models) -> DataFrame:
    """A load whose target table does not exist yet: everything is new, by authority."""
    held = watermark.table_or_none(m.spark, "demand_never_loaded")
    fresh = watermark.newer_than(m.stage_demand, "source_uploaded_at", held)
    return fresh.groupBy("balancing_authority").agg(F.count(F.lit(1)).alias("hours"), F.sum("demand_mwh").alias("demand_mwh"))


def _calendar(m: Models) -> DataFrame:
    """The calendar in date order, as it is shown."""
    return m.dates.orderBy("date")


def _weather_rollup(m: Models) -> DataFrame:
    return stats.weather_rollup(m.stage_weather, ["station_id", "date"])


def _baseline(m: Models) -> DataFrame:
    return stats.baseline(
        m.stage_demand, ["balancing_authority", "hour_of_day", "day_part"], "demand_mwh", "baseline_mwh"
    )


def _long_changes(m: Models) -> DataFrame:
    """Hourly change, trailing mean and reach-back over many slices of each station's whole history."""
    return series.sliced(
        m.stage_weather.select("station_id", "timestamp", "date", "temperature_c"),
        ["station_id"],
        "timestamp",
        facts.month_cut(),
        24,
        lambda w: {
            "change_1": series.delta("temperature_c", w, 1),
            "change_24": series.delta("temperature_c", w, 24),
            "mean_24": series.trailing_mean("temperature_c", w, 24),
        },
    )


def _unique(m: Models) -> DataFrame:
    return quality.violations_unique(adapters.table(m.spark, m.sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _not_null(m: Models) -> DataFrame:
    return quality.violations_not_null(m.stage_demand, "demand_mwh").select("demand_id", "balancing_authority", "timestamp")


def _accepted(m: Models) -> DataFrame:
    rows = quality.violations_accepted(m.stage_demand, "day_part", ["MORNING_PEAK", "MIDDAY", "EVENING_PEAK"])
    return rows.select("demand_id", "day_part")


def _relationships(m: Models) -> DataFrame:
    customers = adapters.table(m.spark, m.sf_dir, "customer")
    orders = adapters.table(m.spark, m.sf_dir, "orders")
    return quality.violations_fk(customers, "c_custkey", orders, "o_custkey").select("c_custkey", "c_name")


def _quality_suite(m: Models) -> DataFrame:
    """Violation counts of every declared check of the source-near models and facts."""
    frames = {
        "stage_demand": m.stage_demand_table,
        "stage_sales": settle(m.stage_sales, "sales"),
        "stage_weather": settle(m.stage_weather, "weather"),
        "station_metadata": m.station_metadata,
        "stage_generation": m.stage_generation_table,
        "dim_location": m.authorities_table.unionByName(m.stations_table).unionByName(m.states_table),
        "dim_energy_source": m.sources_table,
        "dim_date": m.dates,
        "fact_demand": settle(m.fact_demand, "demand"),
        "fact_weather": m.weather_hours_table,
        "fact_generation": settle(m.fact_generation, "generation"),
        "fact_sales": settle(m.fact_sales, "sales"),
        "location_bridge": m.bridge_table,
    }
    results = [checks.check_model(model, frames) for model in frames]
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    return every


QUERIES: dict[str, Callable[[Models], DataFrame]] = {
    "q_trailing_avg": _trailing_avg,
    "q_stage_demand": lambda m: m.stage_demand,
    "q_stage_generation": lambda m: m.stage_generation,
    "q_stage_sales": lambda m: m.stage_sales,
    "q_stage_weather": lambda m: m.stage_weather,
    "q_station_metadata": lambda m: m.station_metadata,
    "q_isd_parse": _isd,
    "q_isd_rejects": _isd_rejects,
    "q_manifest_load": _manifest_load,
    "q_landed_json": _landed_json,
    "q_landed_lines": _landed_lines,
    "q_open_payload": _open_payload,
    "q_watermark": _watermark,
    "q_newer_than": _newer_than,
    "q_dim_date": _observed_calendar,
    "q_calendar": _calendar,
    "q_table_writers": _table_writers,
    "q_first_run": _first_run,
    "q_dim_energy_source": lambda m: m.energy_sources,
    "q_dim_location": lambda m: m.locations,
    "q_bridge": lambda m: m.bridge_table,
    "q_fact_demand": lambda m: m.fact_demand,
    "q_fact_weather": lambda m: m.fact_weather,
    "q_fact_generation": lambda m: m.fact_generation,
    "q_fact_sales": lambda m: m.fact_sales,
    "q_generation_mix": lambda m: analytics.generation_mix(m.monthly_generation),
    "q_generation_mix_all_sectors": lambda m: analytics.generation_mix(m.monthly_generation, match_sector=False),
    "q_weather_demand_correlation": lambda m: m.correlation,
    "q_weather_demand_correlation_default": _correlation_default,
    "q_season_thresholds": _season_thresholds,
    "q_peak_drivers": lambda m: m.peak_drivers,
    "q_cumulative_patterns": lambda m: m.cumulative,
    "q_cumulative_first_load": _first_load,
    "q_state_changes": lambda m: m.state_changes,
    "q_group_percentiles": _group_percentiles,
    "q_group_percentile_approx": _group_percentiles_approx,
    "q_percent_rank": _percent_rank,
    "q_line_price_rank": _line_quantity_ranks,
    "q_weather_rollup": _weather_rollup,
    "q_baseline": _baseline,
    "q_long_changes": _long_changes,
    "q_place_history": _place_history,
    "q_validity_join": _validity,
    "q_validity_many_versions": _validity_many,
    "q_upsert": _upsert,
    "q_insert_only": _insert_only,
    "q_schema_evolution": _schema_evolution,
    "q_schema_modes": _schema_modes,
    "q_incremental_demand": _demand_increment,
    "q_incremental_weather": _weather_increment,
    "q_incremental_generation": _generation_increment,
    "q_incremental_sales": _sales_increment,
    "q_incremental_cumulative": _cumulative_increment,
    "q_incremental_states": _state_increment,
    "q_captured_states": _captured_states,
    "q_stream_demand": _stream_demand,
    "q_partitioned_write": _partitioned,
    "q_unique": _unique,
    "q_not_null": _not_null,
    "q_accepted_values": _accepted,
    "q_relationships": _relationships,
    "q_quality_suite": _quality_suite,
    "q_report_timeline": lambda m: reports.state_timeline(m.state_changes),
    "q_report_drivers_long": lambda m: reports.drivers_long(m.peak_drivers),
    "q_report_peaks": lambda m: reports.peak_timeline(m.peak_drivers),
    "q_report_daily_corr": lambda m: reports.daily_correlation(m.correlation),
    "q_report_trailing": lambda m: reports.trailing_averages(m.cumulative),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Callable[[Models], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: rounded(build(Models(spark, sf_dir)))

    return {name: runner(build) for name, build in QUERIES.items()}
