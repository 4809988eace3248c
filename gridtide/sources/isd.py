"""Fixed-width hourly weather records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed_values as fixed
from ..functions.numeric import parse_number


def read_isd(spark: SparkSession, path: str) -> DataFrame:
    """Lines of plain or gzipped record files."""
    return spark.read.text(path)


def _slice(line: Column, name: str) -> Column:
    start, length = fixed.ISD_FIELDS[name]
    return F.trim(F.substring(line, start + 1, length))


def _whole(text: Column) -> Column:
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def _tenths(text: Column) -> Column:
    return parse_number(text) / fixed.ISD_SCALE


def judged_isd(lines: DataFrame, line: str = "value") -> DataFrame:
    """Every line with its fields, ``wind_place`` and ``reject_reason`` (NULL for a record), in one pass.

    Reasons, the first that holds: ``short`` line, unreadable ``date``, ``temperature``, ``dew_point``, ``pressure``.
    A sentinel gives NULL. Wind is the first of its candidate places that holds a number, 0 being the first place;
    a line without one is a record without wind.
    """
    text = F.coalesce(F.col(line), F.lit(""))
    parts = lines.select(
        F.col(line).alias("line"),
        (F.length(text) <= fixed.ISD_LONGER_THAN).alias("_short"),
        *[_slice(text, name).alias(name) for name in fixed.ISD_FIELDS],
        *[
            F.trim(F.substring(text, start + 1, fixed.ISD_WIND_LENGTH)).alias(f"wind_{start}")
            for start in fixed.ISD_WIND_STARTS
        ],
    )
    clock = [_whole(F.col(name)) for name in ("year", "month", "day", "hour", "minute")]
    missing = {
        "temperature": F.col("temperature") == fixed.ISD_SIGNED_MISSING,
        "dew_point": F.col("dew_point") == fixed.ISD_SIGNED_MISSING,
        "pressure": F.col("pressure").isin("", fixed.ISD_MISSING),
    }
    winds = [
        F.when(F.col(f"wind_{start}") != fixed.ISD_MISSING, _tenths(F.col(f"wind_{start}")))
        for start in fixed.ISD_WIND_STARTS
    ]
    typed = parts.select(
        "line",
        "_short",
        F.concat_ws("-", "usaf", "wban").alias("station_id"),
        F.call_function("try_make_timestamp_ntz", *clock, F.lit(0)).alias("timestamp"),
        *[
            F.when(~missing[name], _tenths(F.col(name))).alias(output)
            for name, output in (
                ("temperature", "temperature_c"),
                ("dew_point", "dew_point_c"),
                ("pressure", "pressure_hpa"),
            )
        ],
        F.coalesce(*winds).alias("wind_speed_ms"),
        F.coalesce(*[F.when(wind.isNotNull(), i) for i, wind in enumerate(winds)]).alias("wind_place"),
        *[(~absent & parse_number(F.col(name)).isNull()).alias(f"_bad_{name}") for name, absent in missing.items()],
    )
    reason = F.when(F.col("_short"), "short").when(F.col("timestamp").isNull(), "date")
    for name in missing:
        reason = reason.when(F.col(f"_bad_{name}"), name)
    return typed.withColumn("reject_reason", reason).drop("_short", *[f"_bad_{name}" for name in missing])


RECORD = ["station_id", "timestamp", "temperature_c", "dew_point_c", "pressure_hpa", "wind_speed_ms"]


def parse_isd(lines: DataFrame, line: str = "value") -> DataFrame:
    """Typed weather records from fixed-width lines; see :func:`judged_isd` for those that give no row."""
    return judged_isd(lines, line).filter(F.col("reject_reason").isNull()).select(*RECORD)


def isd_documents(records: DataFrame) -> DataFrame:
    """Parsed records as the weather payload the staging step reads (one record per document)."""
    clock = [F.lpad(part("timestamp").cast("string"), 2, "0") for part in (F.hour, F.minute)]
    stamp = F.concat(F.to_date("timestamp").cast("string"), F.lit("T"), clock[0], F.lit(":"), clock[1], F.lit(":00Z"))
    reading = F.struct(
        stamp.alias("timestamp"),
        F.col("temperature_c").alias("air_temp_celsius"),
        F.col("dew_point_c").alias("dew_point_celsius"),
        F.col("pressure_hpa").alias("sea_level_pressure_hpa"),
        F.col("wind_speed_ms").alias("wind_speed_mps"),
    )
    document = F.array(F.struct(F.col("station_id").alias("station"), stamp.alias("timestamp"), reading.alias("raw_data")))
    return records.select("station_id", F.year("timestamp").alias("year"), F.to_json(document).alias("raw_data"))
