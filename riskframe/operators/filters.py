"""Row filters and the value lists that feed them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.timeparts import instant
from riskframe.schema import ALL_PLACES, ALL_WEAPONS, CRIME, ID, PLACE, SHIFT, TIME, WEAPON


class TooFewRows(ValueError):
    """The data are too small for the requested analysis."""


# fixed values: fewest rows for each analysis
FEWEST_ROWS = {
    "model training": 50,
    "model view": 101,
    "performance curve": 51,
    "unsupervised analysis": 50,
    "cluster sweep": 4,
}


def at_least(df: DataFrame, rows: int, purpose: str) -> DataFrame:
    """Pass the frame through, or raise if it has fewer than ``rows`` rows."""
    if df.limit(rows).count() < rows:
        raise TooFewRows(f"{purpose} needs at least {rows} rows")
    return df


def enough(df: DataFrame, purpose: str) -> DataFrame:
    """Pass the frame through, or raise if it has fewer rows than this analysis needs (``FEWEST_ROWS``)."""
    return at_least(df, FEWEST_ROWS[purpose], purpose)


def in_dates(df: DataFrame, start: dt.date, end: dt.date, end_inclusive_midnight: bool = False) -> DataFrame:
    """Both days included; rows without a time are left out.

    Plain comparisons on the time column, so they reach the Parquet scan.  The
    older rule also takes the first instant after the last day.
    """
    first = dt.datetime.combine(start, dt.time())
    after = dt.datetime.combine(end, dt.time()) + dt.timedelta(days=1)
    low, high = instant(first), instant(after)
    upper = F.col(TIME) <= high if end_inclusive_midnight else F.col(TIME) < high
    return df.where((F.col(TIME) >= low) & upper)


def pick(
    df: DataFrame,
    place: str = ALL_PLACES,
    crime: str = ALL_PLACES,
    weapon: str = ALL_WEAPONS,
    shifts: list[str] | None = None,
) -> DataFrame:
    """Equality filters; the 'all' value or an empty list means no filter."""
    for name, value, everything in (
        (PLACE, place, ALL_PLACES),
        (CRIME, crime, ALL_PLACES),
        (WEAPON, weapon, ALL_WEAPONS),
    ):
        if value != everything and name in df.columns:
            df = df.where(F.col(name) == value)
    if shifts and SHIFT in df.columns:
        df = df.where(F.col(SHIFT).isin(shifts))
    return df


def options(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values for a chooser."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def cascading_options(df: DataFrame, place: str = ALL_PLACES, crime: str = ALL_PLACES) -> DataFrame:
    """Choices of place, crime and weapon, each from rows that pass the choices before it."""
    frames = []
    for field, frame in (
        (PLACE, df),
        (CRIME, pick(df, place=place)),
        (WEAPON, pick(df, place=place, crime=crime)),
    ):
        frames.append(options(frame, field).select(F.lit(field).alias("field"), F.col(field).alias("value")))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.to_date(F.min(TIME)).alias("min_date"),
        F.to_date(F.max(TIME)).alias("max_date"),
    )


def newest(df: DataFrame, rows: int = 200) -> DataFrame:
    """The latest ``rows`` incidents by time (a top-k, not a sample)."""
    return df.orderBy(F.col(TIME).desc_nulls_last(), F.col(ID).desc()).limit(rows)


def last_hours(df: DataFrame, hours: int = 24) -> DataFrame:
    """Rows less than ``hours`` older than the newest one."""
    latest = df.agg(F.max(TIME).alias("t")).first()["t"]
    if latest is None:
        return df.where(F.lit(False))
    return df.where(F.col(TIME) > instant(latest - dt.timedelta(hours=hours)))
