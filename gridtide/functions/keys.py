"""Keys that are stable across runs and engines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import KEY_NULL_TEXT


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 over the text of the columns; NULL has its own text, so it differs from an empty string.

    Doubles must be passed through :func:`number_text`, because engines print them differently.
    """
    texts = [F.coalesce(as_column(c).cast("string"), F.lit(KEY_NULL_TEXT)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def number_text(column: Column | str, scale: int = 6) -> Column:
    """A number as fixed-point text."""
    return as_column(column).cast(f"decimal(38,{scale})").cast("string")
