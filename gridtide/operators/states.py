"""Demand states of a series and the events at which the state changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fixed
from ..functions.calendar import minutes_between
from ..functions.classify import bucket
from .joins import null_safe_join
from .ranks import group_percentiles
from .series import sliced


def state_thresholds(
    df: DataFrame, by: Sequence[str], value: str, states=fixed.DEMAND_STATES, exact: bool = True
) -> DataFrame:
    """One row per group with a threshold column per state."""
    return group_percentiles(df, by, value, {name: p for name, p in states}, exact=exact)


def classify_by_thresholds(
    df: DataFrame,
    thresholds: DataFrame,
    by: Sequence[str],
    value: str,
    output: str,
    states=fixed.DEMAND_STATES,
    default: str = fixed.DEMAND_STATE_DEFAULT,
) -> DataFrame:
    """The first state whose threshold the value exceeds. A missing value takes the default state."""
    joined = null_safe_join(df, thresholds, by, "left")
    rules = [(F.col(value) > F.col(name), name) for name, _ in states]
    return joined.withColumn(output, bucket(rules, default)).drop(*[name for name, _ in states])


def state_changes(
    df: DataFrame, by: Sequence[str], order: str, state: str, cut: Column, before: DataFrame | None = None
) -> DataFrame:
    """Rows whose state differs from the row before; the first row of a series is no change.

    Adds ``from_state``, ``to_state``, ``previous_state_duration_minutes`` (gap to the row before) and
    ``from_state_total_minutes`` (since the series entered the state it now leaves; NULL at the first change).

    ``before`` holds the last row before ``df`` of series that go on (``by``, ``order``, ``state``) and in
    ``changed_at`` the time of their last change, NULL if there was none. ``cut`` may use the order column only then.
    """
    rows = df.withColumn("_before", F.lit(False))
    if before is not None:
        last = before.select(*by, order, state, F.lit(True).alias("_before"))
        rows = rows.unionByName(last, allowMissingColumns=True)
    marked = sliced(
        rows,
        by,
        order,
        cut,
        1,
        lambda w: {"from_state": F.lag(state).over(w), "_previous_time": F.lag(order).over(w)},
    )
    changes = marked.filter(~F.col("_before") & (F.col(state) != F.col("from_state"))).select(
        *[c for c in df.columns if c != state],
        "from_state",
        F.col(state).alias("to_state"),
        minutes_between("_previous_time", order).alias("previous_state_duration_minutes"),
        "_before",
    )
    if before is not None:
        last = before.filter(F.col("changed_at").isNotNull())
        last = last.select(*by, F.col("changed_at").alias(order), F.lit(True).alias("_before"))
        changes = changes.unionByName(last, allowMissingColumns=True)
    timed = sliced(
        changes,
        by,
        order,
        cut,
        1,
        lambda w: {"from_state_total_minutes": minutes_between(F.lag(order).over(w), order)},
    )
    return timed.filter(~F.col("_before")).drop("_before")


def classify_trigger(hour: str, from_state: str, to_state: str, is_weekend: str, temperature: str) -> Column:
    """Likely cause of a state change; the first rule that holds counts."""
    hour, source, target = F.col(hour), F.col(from_state), F.col(to_state)
    t = F.col(temperature)
    top = target.isin("PEAK", "CRITICAL")
    return bucket(
        [
            (
                hour.between(*fixed.MORNING_RAMP_HOURS) & target.isin("HIGH", "PEAK") & source.isin("LOW", "NORMAL"),
                "MORNING_RAMP",
            ),
            (hour.between(*fixed.EVENING_PEAK_HOURS) & top, "EVENING_PEAK"),
            (
                F.col(is_weekend) & source.isin("NORMAL", "HIGH", "PEAK") & target.isin("LOW", "NORMAL"),
                "WEEKEND_REDUCTION",
            ),
            (((t > fixed.TRIGGER_HOT_C) | (t < fixed.TRIGGER_COLD_C)) & top, "EXTREME_TEMPERATURE"),
        ],
        "NORMAL_FLUCTUATION",
    )
