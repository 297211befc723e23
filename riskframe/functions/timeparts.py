"""Calendar and shift expressions over an event time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.schema import DAY_NAMES, NOT_INFORMED


def instant(moment: dt.datetime) -> Column:
    """Literal time without zone; going through text keeps driver and session zones out of it."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def shift_of_hour(hour: Column, missing: str = NOT_INFORMED) -> Column:
    """Shift name of an hour 0..23: six hours each, from midnight on."""
    return (
        F.when(hour.isNull(), missing)
        .when(hour.between(6, 11), "Manhã")
        .when(hour.between(12, 17), "Tarde")
        .when(hour.between(18, 23), "Noite")
        .otherwise("Madrugada")
    )


def time_parts(time: Column, missing_shift: str = NOT_INFORMED) -> dict[str, Column]:
    """Derived time columns; all null (shift: ``missing_shift``) where the time is."""
    monday_first = F.weekday(time)
    return {
        "ano": F.year(time),
        "mes": F.month(time),
        "dia": F.dayofmonth(time),
        "hora": F.hour(time),
        "dia_semana": F.date_format(time, "EEEE"),
        "dia_semana_idx": monday_first,
        "ano_mes": F.date_format(time, "yyyy-MM"),
        "fim_semana": monday_first.isin(5, 6).cast("int"),
        "turno": shift_of_hour(F.hour(time), missing_shift),
    }


def day_order(day_name: Column) -> Column:
    """0 for Monday to 6 for Sunday, from the English day name."""
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return (F.array_position(names, day_name) - 1).cast("int")


def event_micros(time: Column) -> Column:
    """Microseconds since 1970 of a time without zone (independent of the session zone)."""
    days = F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = (days * 24 + F.hour(time)) * 3600 + F.minute(time) * 60
    micros = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")
    return seconds * 1_000_000 + micros
