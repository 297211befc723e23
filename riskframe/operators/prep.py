"""Cleaning: parse times, derive time parts and the label, fill gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.numeric import as_number
from riskframe.functions.quantiles import exact_quantiles
from riskframe.functions.risk import value_in
from riskframe.functions.timeparts import time_parts
from riskframe.schema import (
    CRIME,
    FILLED_NUMBERS,
    FILLED_TEXT,
    LABEL,
    LETHAL_WEAPONS,
    NIGHT_SHIFTS,
    NOT_INFORMED,
    SHIFT,
    TIME,
    VIOLENT_CRIMES,
    WEAPON,
)

#: Kinds of written times other than ISO, with their patterns.
TIME_PATTERNS = {
    f"{order} first": [f"{date}{time}" for date in dates for time in (" H:m:s", " H:m", "")]
    for order, dates in {
        "month": ("M/d/yyyy", "M-d-yyyy"),
        "day": ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy"),
    }.items()
}


def fit_medians(df: DataFrame, columns: list[str] = FILLED_NUMBERS) -> dict[str, float | None]:
    """Exact medians of the columns that exist.  Fit on the whole, unfiltered data."""
    present = {c: as_number(F.col(c)) for c in columns if c in df.columns}
    if not present:
        return {}
    return {c: values[0] for c, values in exact_quantiles(df, present, [0.5]).items()}


def time_reading(column: Column, pattern: str | None) -> Column:
    if pattern is None:
        return column.try_cast("timestamp_ntz")
    text = column.cast("string")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in TIME_PATTERNS[pattern]])


def fit_time_format(df: DataFrame) -> str | None:
    """The kind of time text that the file has: None for ISO, or a key of ``TIME_PATTERNS``.

    The kind that reads the most values wins; on equal numbers ISO comes first, then month first.
    One pass over the time column, and none if it is typed.
    """
    if dict(df.dtypes).get(TIME) != "string":
        return None
    kinds = [None, *TIME_PATTERNS]
    counts = df.agg(*[F.count(time_reading(F.col(TIME), k)).alias(f"n{i}") for i, k in enumerate(kinds)]).first()
    return kinds[max(range(len(kinds)), key=lambda i: (counts[i], -i))]


def clean(
    df: DataFrame,
    medians: dict[str, float | None],
    text_label: str = NOT_INFORMED,
    missing_shift: str = NOT_INFORMED,
    time_format: str | None = None,
) -> DataFrame:
    """Cleaned incidents; absent optional columns are skipped.

    Medians enter as literals, so the whole step is one projection of the scan.
    An empty ``medians`` leaves numeric nulls as they are.  ``time_format`` is what
    ``fit_time_format`` finds.
    """
    out = {}
    if TIME in df.columns:
        time = time_reading(F.col(TIME), time_format)
        out[TIME] = time
        out.update(time_parts(time, missing_shift))
    for name in FILLED_TEXT:
        if name in df.columns:
            out[name] = F.coalesce(F.col(name), F.lit(text_label))
    for name in FILLED_NUMBERS:
        if name in df.columns:
            number = as_number(F.col(name))
            median = medians.get(name)
            out[name] = number if median is None else F.coalesce(number, F.lit(median))
    if WEAPON in df.columns:
        out[LABEL] = value_in(F.col(WEAPON), LETHAL_WEAPONS)
    return df.withColumns(out)


def with_flags(df: DataFrame) -> DataFrame:
    """Lethal-weapon, violent-crime and night flags (only for columns that exist)."""
    rules = {
        "arma_letal": (WEAPON, LETHAL_WEAPONS),
        "crime_violento": (CRIME, VIOLENT_CRIMES),
        "periodo_noturno": (SHIFT, NIGHT_SHIFTS),
    }
    return df.withColumns(
        {flag: value_in(F.col(c), values) for flag, (c, values) in rules.items() if c in df.columns}
    )
