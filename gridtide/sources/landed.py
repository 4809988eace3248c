"""Landed JSON documents: scan, parse, unnest, newest batch."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .tables import settle

DEMAND_PAYLOAD = (
    "struct<response: struct<data: array<struct<period: string, value: string, `value-units`: string>>>>"
)
GENERATION_PAYLOAD = (
    "struct<response: struct<data: array<struct<period: string, location: string, stateDescription: string, "
    "fueltypeid: string, fuelTypeDescription: string, sectorid: string, sectorDescription: string, "
    "generation: string, `generation-units`: string>>>>"
)
SALES_PAYLOAD = (
    "struct<response: struct<data: array<struct<period: string, stateid: string, stateDescription: string, "
    "sectorid: string, sectorName: string, sales: string, revenue: string, price: string, customers: string>>>>"
)
WEATHER_PAYLOAD = (
    "array<struct<station: string, timestamp: string, raw_data: struct<timestamp: string, "
    "air_temp_celsius: double, dew_point_celsius: double, sea_level_pressure_hpa: double, wind_speed_mps: double>>>"
)


def read_landed_json(
    spark: SparkSession,
    path: str | list[str],
    name_pattern: str | None = None,
    tags: tuple[str, ...] = (),
    whole_file: bool = True,
) -> DataFrame:
    """One row per landed document: ``id, file_name, uploaded_at, data_date, <tags>, raw_data``.

    A file holds one document, or with ``whole_file=False`` one document per line (files of any size, split
    over tasks); ``id`` is then the line's place in its file, so of two documents of one file the later one counts
    as newer. ``name_pattern`` is matched against the full path; its groups become the ``tags``.
    """
    if whole_file:
        return stamp_landed(spark.read.text(path, wholetext=True), name_pattern, tags)
    return stamp_landed(spark.read.text(path), name_pattern, tags, place=True).transform(numbered_lines)


#: Splits of files whose starts are sent to all tasks; beyond it they are joined by shuffle.
BROADCAST_SPLITS = 1_000_000


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Turns the marks of ``stamp_landed(place=True)`` into ``id``, the place of a line in its file, from 0.

    A split of a file counts its own lines; it starts after the lines of the splits before it. Only one row a split
    is summed up, and reading the files twice costs less than shuffling them.
    """
    splits = lines.groupBy("_path", "_block").agg(F.min("_mark").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("_path", "_block", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    starts = settle(starts, "splits")
    if starts.count() <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    placed = lines.join(starts, ["_path", "_block"])
    id = (F.col("_before") + F.col("_mark") - F.col("_first")).alias("id")
    return placed.select(id, *[c for c in lines.columns if c not in ("id", "_path", "_block", "_mark")])


def stamp_landed(
    lines: DataFrame, name_pattern: str | None = None, tags: tuple[str, ...] = (), place: bool = False
) -> DataFrame:
    """Adds lineage from the file metadata. Works on a batch and on a stream.

    With ``place`` the marks that :func:`numbered_lines` needs are kept: path, split, and order in the split.
    """
    uploaded = F.col("_metadata.file_modification_time")
    tag_columns = [
        F.regexp_extract(F.col("_metadata.file_path"), name_pattern, group).alias(tag)
        for group, tag in enumerate(tags, start=1)
    ]
    marks = [
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mark"),
    ]
    return lines.select(
        F.unix_micros(uploaded).alias("id"),
        F.col("_metadata.file_name").alias("file_name"),
        uploaded.cast("timestamp_ntz").alias("uploaded_at"),
        uploaded.cast("date").alias("data_date"),
        *tag_columns,
        F.col("value").alias("raw_data"),
        *(marks if place else []),
    )


def parse_payload(df: DataFrame, payload: str | None, column: str = "raw_data") -> DataFrame:
    """Text document to a typed column; without a schema to VARIANT, which keeps any shape."""
    parsed = F.from_json(column, payload) if payload else F.try_parse_json(F.col(column))
    return df.withColumn(column, parsed)


def explode_payload(df: DataFrame, path: str, item: str = "item", with_index: bool = False) -> DataFrame:
    """One row per element of the array at ``path``; documents without elements give no row.

    A plain ``explode`` makes the optimizer add a filter on the array's size, which parses every document once
    more. The outer form followed by a filter gives the same rows from one parse.
    """
    carried = [F.col(c) for c in df.columns if c != path.split(".")[0]]
    if with_index:
        exploded = df.select(*carried, F.posexplode_outer(path).alias(f"{item}_index", item))
    else:
        exploded = df.select(*carried, F.explode_outer(path).alias(item))
    return exploded.filter(F.col(item).isNotNull())


def explode_variant(df: DataFrame, path: str, column: str = "raw_data", item: str = "item") -> DataFrame:
    """As :func:`explode_payload` for a VARIANT column; ``path`` is like ``$.response.data``."""
    array = F.variant_get(column, path, "array<variant>")
    exploded = df.select(*[F.col(c) for c in df.columns if c != column], F.explode_outer(array).alias(item))
    return exploded.filter(F.col(item).isNotNull())


def variant_field(item: str, key: str, type_name: str = "string") -> Column:
    """Field of a VARIANT by name; any key is allowed, also one with a dash."""
    return F.try_variant_get(F.col(item), f"$['{key}']", type_name)


def file_names(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path`` and ``file_name`` (its path below the folder) of the files there; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    root = "/" + re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "", folder).strip("/") + "/"
    below = F.expr("substring(path, instr(path, root) + length(root))")
    return files.select("path").withColumn("root", F.lit(root)).select("path", below.alias("file_name"))


def newest_manifest(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """Text of the newest manifest by name, in column ``manifest`` (no row when there is none).

    It is chosen from the names alone; the other manifests are not read.
    """
    names = file_names(spark, folder, f"{prefix}*.json")
    newest = names.agg(F.max_by("path", "file_name")).first()[0]
    if newest is None:
        return spark.createDataFrame([], "manifest string")
    return spark.read.text(newest, wholetext=True).withColumnRenamed("value", "manifest")


def latest_manifest_files(spark: SparkSession, folder: str, prefix: str, layout: Mapping[str, str]) -> DataFrame:
    """Files named by the newest manifest: column ``file_name``.

    ``layout`` says where the manifest keeps them, one of ``{"list": field, "name": field in an element}``,
    ``{"pattern": field, "fill": field}`` (each filler replaces the ``*``), or ``{"single": field}``.
    """
    text = newest_manifest(spark, folder, prefix)
    if "list" in layout:
        schema = f"struct<`{layout['list']}`: array<struct<`{layout['name']}`: string>>>"
        names = F.explode(f"doc.{layout['list']}.{layout['name']}")
    elif "pattern" in layout:
        schema = f"struct<`{layout['pattern']}`: string, `{layout['fill']}`: array<string>>"
        names = F.explode(f"doc.{layout['fill']}")
    else:
        schema = f"struct<`{layout['single']}`: string>"
        names = F.col(f"doc.{layout['single']}")
    parsed = text.select(F.from_json("manifest", schema).alias("doc"))
    files = parsed.select("doc", names.alias("file_name"))
    if "pattern" in layout:
        filled = F.replace(F.col(f"doc.{layout['pattern']}"), F.lit("*"), F.col("file_name"))
        files = files.withColumn("file_name", filled)
    return files.select("file_name").filter(F.length("file_name") > 0).distinct()


def keep_listed(landed: DataFrame, files: DataFrame) -> DataFrame:
    """Landed documents whose file is listed; listed files that never arrived are simply absent."""
    return landed.join(files, "file_name", "left_semi")


def read_listed_json(
    spark: SparkSession,
    folder: str,
    files: DataFrame,
    name_pattern: str | None = None,
    tags: tuple[str, ...] = (),
    whole_file: bool = True,
) -> DataFrame:
    """Documents of the listed files only; other files of the folder are not opened, absent ones are left out.

    The names that a manifest lists and the folder holds go through the driver, as any list of files to read does.
    """
    listed = [r.path for r in keep_listed(file_names(spark, folder), files).collect()]
    if not listed:
        columns = [*(f"{tag} string" for tag in tags), "raw_data string"]
        return spark.createDataFrame([], "id long, file_name string, uploaded_at timestamp_ntz, data_date date, " + ", ".join(columns))
    return read_landed_json(spark, listed, name_pattern, tags, whole_file)
