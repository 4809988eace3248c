"""Demand states of authorities: all changes at once, or run by run with a carried state.

An authority is told by its code; its location key may be missing. Runs classify a row once, by the thresholds of the
run that first saw it, and a carried row per authority says where the next run goes on:

- ``settled_at``, ``settled_state``, ``changed_at``: the last row that no later run touches (``days`` before the newest
  one), its state, and the last change up to it; ``uploaded`` is the newest upload seen.
- the *journal* has the rows after it with the states they were given, *open* changes are those among them.

A run takes an authority's uploads beyond its own ``uploaded`` mark, derives the rows after ``settled_at`` again (held
rows keep their states, new and revised ones are classified) and so replaces the open changes; settled ones never
change. Rows that arrive for a time up to ``settled_at`` come too late and are left out. After any number of runs the
settled and the open changes together are those of one pass over all rows with the states they were given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fixed
from ..functions.classify import bucket
from ..functions.keys import surrogate_key
from ..operators.joins import bridge_first, null_safe_join
from ..operators.states import classify_by_thresholds, classify_trigger, state_changes, state_thresholds
from ..sources.tables import settle
from .facts import month_cut

SERIES = ["balancing_authority_id", "balancing_authority"]
ROW = [*SERIES, "timestamp", "source_uploaded_at", "source_id"]
LEVELS = [name for name, _ in fixed.DEMAND_STATES]
_SERIES = "balancing_authority_id string, balancing_authority string"
CARRY = f"{_SERIES}, settled_at timestamp_ntz, settled_state string, changed_at timestamp_ntz, uploaded timestamp_ntz, version int"
JOURNAL = f"{_SERIES}, timestamp timestamp_ntz, source_uploaded_at timestamp_ntz, source_id long, demand_state string, version int"


def demand_rows(demand: DataFrame, dates: DataFrame) -> DataFrame:
    """Demand facts of calendar days, under the names the states use."""
    facts = demand.select(
        F.col("location_id").alias("balancing_authority_id"),
        "balancing_authority",
        "timestamp",
        "date_id",
        "hour_of_day",
        "demand_mwh",
        "source_uploaded_at",
        "source_id",
    )
    return facts.join(dates.select("date_id"), "date_id", "left_semi")


def authority_thresholds(demand: DataFrame) -> DataFrame:
    """Each authority's own percentiles of all its demand, one column per state."""
    named = demand.select(F.col("location_id").alias("balancing_authority_id"), "balancing_authority", "demand_mwh")
    return state_thresholds(named, SERIES, "demand_mwh")


def described_changes(changes: DataFrame, weather: DataFrame, dates: DataFrame, bridge: DataFrame) -> DataFrame:
    """State changes with trigger, calendar and the first reading of the authority's stations in that hour."""
    one = bridge_first(
        changes,
        bridge,
        weather.withColumnRenamed("timestamp", "weather_timestamp"),
        ["date_id", "hour_of_day"],
        ["weather_timestamp", "station_id"],
        ["temperature_c", "pressure_hpa", "wind_speed_ms"],
        fact_key="balancing_authority_id",
        few=True,
    )
    calendar = dates.select("date_id", "day_name", "is_weekend", "is_holiday")
    # two authorities without a location key are two series, so their ids begin with their codes
    named = one.withColumn("_place", F.coalesce("balancing_authority_id", "balancing_authority"))
    return named.join(calendar, "date_id").select(
        surrogate_key("_place", "timestamp").alias("state_change_id"),
        *SERIES,
        "from_state",
        "to_state",
        F.col("timestamp").alias("state_change_timestamp"),
        "date_id",
        "previous_state_duration_minutes",
        "from_state_total_minutes",
        classify_trigger("hour_of_day", "from_state", "to_state", "is_weekend", "temperature_c").alias(
            "change_trigger"
        ),
        F.col("demand_mwh").alias("demand_at_change_mwh"),
        "temperature_c",
        "pressure_hpa",
        "wind_speed_ms",
        "day_name",
        "is_weekend",
        "is_holiday",
    )


def grid_state_changes(
    demand: DataFrame,
    weather: DataFrame,
    dates: DataFrame,
    bridge: DataFrame,
    thresholds: DataFrame | None = None,
    cut: Column | None = None,
) -> DataFrame:
    """Changes of the demand state of each authority over all its rows, with trigger, gap and weather.

    States come from each authority's own percentiles (pass them settled on large data). Weather and calendar are
    joined to the changes only, which are far fewer than the demand rows.
    """
    if thresholds is None:
        thresholds = authority_thresholds(demand)
    states = classify_by_thresholds(demand_rows(demand, dates), thresholds, SERIES, "demand_mwh", "demand_state")
    cut = month_cut("timestamp") if cut is None else cut
    changes = state_changes(states, SERIES, "timestamp", "demand_state", cut)
    return described_changes(changes, weather, dates, bridge)


@dataclass(frozen=True)
class Carried:
    """What one run leaves for the next; all of it small beside the demand."""

    carry: DataFrame
    journal: DataFrame
    open_changes: DataFrame


@dataclass(frozen=True)
class Run:
    """``settled`` are the changes that became final in this run, ``thresholds`` the versions it derived."""

    carried: Carried
    settled: DataFrame
    thresholds: DataFrame


def _without(df: DataFrame, touched: DataFrame) -> DataFrame:
    renamed = touched.select(*[F.col(c).alias(f"_{c}") for c in SERIES])
    same = [df[c].eqNullSafe(renamed[f"_{c}"]) for c in SERIES]
    return df.join(renamed, same, "left_anti")


def grid_state_run(
    demand: DataFrame,
    weather: DataFrame,
    dates: DataFrame,
    bridge: DataFrame,
    carried: Carried | None = None,
    days: int = 1,
    cut: Column | None = None,
) -> Run:
    """The next run over all demand that has arrived. ``days`` is how far back rows may still arrive or be revised.

    Only authorities with new uploads are worked on, and of those only the rows after their settled one, except for
    the thresholds, which count all values of such an authority.
    """
    spark = demand.sparkSession
    rows = demand_rows(demand, dates)
    carry = carried.carry if carried else spark.createDataFrame([], CARRY)
    known = null_safe_join(rows.select(*ROW), carry, SERIES, "left")
    fresh = known.filter(F.col("uploaded").isNull() | (F.col("source_uploaded_at") > F.col("uploaded")))
    marks = fresh.groupBy(*SERIES).agg(F.max("source_uploaded_at").alias("_uploaded"))
    touched = settle(
        null_safe_join(marks, carry, SERIES, "left")
        .withColumns({"uploaded": F.col("_uploaded"), "version": F.coalesce("version", F.lit(0)) + 1})
        .drop("_uploaded"),
        "touched",
    )
    theirs = demand.withColumnRenamed("location_id", "balancing_authority_id")
    theirs = null_safe_join(theirs.select(*SERIES, "demand_mwh"), touched.select(*SERIES), SERIES)
    levels = state_thresholds(theirs, SERIES, "demand_mwh")
    levels = settle(null_safe_join(touched.select(*SERIES, "version"), levels, SERIES, "left"), "thresholds")

    after = null_safe_join(rows, touched.select(*SERIES, "settled_at"), SERIES)
    after = after.filter(F.col("settled_at").isNull() | (F.col("timestamp") > F.col("settled_at"))).drop("settled_at")
    if carried:
        held = carried.journal.withColumnsRenamed({"demand_state": "_state", "version": "_version"})
        after = null_safe_join(after, held, ROW, "left")
    else:
        after = after.withColumns({"_state": F.lit(None).cast("string"), "_version": F.lit(None).cast("int")})
    now = bucket([(F.col("demand_mwh") > F.col(name), name) for name in LEVELS], fixed.DEMAND_STATE_DEFAULT)
    given = {"demand_state": F.coalesce("_state", now), "version": F.coalesce("_version", "version")}
    states = null_safe_join(after, levels, SERIES).withColumns(given).drop("_state", "_version", *LEVELS)
    states = settle(states, "states")

    before = touched.filter(F.col("settled_at").isNotNull()).select(
        *SERIES, F.col("settled_at").alias("timestamp"), F.col("settled_state").alias("demand_state"), "changed_at"
    )
    slices = month_cut("timestamp") if cut is None else cut
    found = state_changes(states.drop("version"), SERIES, "timestamp", "demand_state", slices, before)
    changes = settle(described_changes(found, weather, dates, bridge), "changes")

    newest = states.groupBy(*SERIES).agg((F.max("timestamp") - F.make_dt_interval(F.lit(days))).alias("_upto"))
    past = null_safe_join(states, newest, SERIES).filter("timestamp <= _upto").groupBy(*SERIES)
    point = past.agg(F.max(F.struct("timestamp", "demand_state")).alias("_point"))
    moved = null_safe_join(touched, point, SERIES, "left").withColumns(
        {
            "settled_at": F.coalesce("_point.timestamp", "settled_at"),
            "settled_state": F.coalesce("_point.demand_state", "settled_state"),
        }
    )
    moved = settle(moved.drop("_point"), "moved")
    bounds = moved.select(*SERIES, F.col("settled_at").alias("_settled_at"))
    timed = null_safe_join(changes, bounds, SERIES)
    final = F.col("state_change_timestamp") <= F.col("_settled_at")
    settled = timed.filter(final).drop("_settled_at")
    still_open = timed.filter(~F.coalesce(final, F.lit(False))).drop("_settled_at")
    last = settled.groupBy(*SERIES).agg(F.max("state_change_timestamp").alias("_last"))
    new_carry = null_safe_join(moved, last, SERIES, "left").withColumn("changed_at", F.coalesce("_last", "changed_at"))
    journal = null_safe_join(states, bounds, SERIES).filter("_settled_at IS NULL OR timestamp > _settled_at")

    columns = carry.columns
    new_carry, journal = new_carry.select(*columns), journal.select(*ROW, "demand_state", "version")
    if carried:
        new_carry = new_carry.unionByName(_without(carry, touched))
        journal = journal.unionByName(_without(carried.journal, touched))
        still_open = still_open.unionByName(_without(carried.open_changes, touched))
    return Run(Carried(new_carry, journal, still_open), settled, levels)
