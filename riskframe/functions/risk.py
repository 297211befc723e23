"""Risk components of one incident as column expressions (all in 0..1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.functions.numeric import clamp
from riskframe.schema import (
    BAND_EDGES,
    BAND_NAMES,
    CRIME_RISK,
    LETHAL_WEAPONS,
    PROTOCOL_CRIMES,
    RISK_WEIGHTS,
    SHIFT_RISK,
    UNKNOWN_PLACE_RISK,
    UNKNOWN_TIME_RISK,
    UNKNOWN_VALUE_RISK,
    WEAPON_RISK,
)


def value_in(value: Column, choices: list[str]) -> Column:
    """1 if the value is one of ``choices``, else 0 (null too)."""
    return F.coalesce(value.isin(choices), F.lit(False)).cast("int")


def looked_up(value: Column, table: dict[str, float], default: float) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def weapon_risk(weapon: Column) -> Column:
    return looked_up(weapon, WEAPON_RISK, UNKNOWN_VALUE_RISK)


def crime_risk(crime: Column) -> Column:
    return looked_up(crime, CRIME_RISK, UNKNOWN_VALUE_RISK)


def suspect_risk(suspects: Column, age: Column | None = None, round_counts: bool = False) -> Column:
    """By number of suspects, shifted by age.

    A fractional count (an imputed median such as 1.5) matches no step and scores
    0; ``round_counts`` rounds counts first.
    """
    count = F.coalesce(suspects, F.lit(1.0))
    if round_counts:
        count = F.rint(count)
    base = (
        F.when(count >= 3, 0.9)
        .when(count == 2, 0.6)
        .when(count == 1, 0.3)
        .when(count == 0, 0.1)
        .otherwise(0.0)
    )
    if age is None:
        return clamp(base)
    shift = F.when(age <= 25, 0.1).when(age >= 50, -0.1).otherwise(0.0)
    return clamp(base + shift)


def location_risk(place_rate: Column) -> Column:
    """Twice the place's share of high-risk incidents, at most 1; unknown place 0.5."""
    known = F.least(place_rate * 2, F.lit(1.0))  # least() alone would skip a null rate
    return F.when(place_rate.isNull(), UNKNOWN_PLACE_RISK).otherwise(known)


def temporal_risk(hour: Column | None, weekday: Column | None, shift: Column | None) -> Column:
    """By shift, by hour where the shift is unknown; Friday to Sunday add 0.1."""
    by_hour = F.lit(UNKNOWN_TIME_RISK)
    if hour is not None:
        by_hour = (
            F.when(hour.isNull(), UNKNOWN_TIME_RISK)
            .when(hour.between(6, 11), 0.3)
            .when(hour.between(12, 17), 0.5)
            .when(hour.between(18, 21), 0.7)
            .when(hour.between(0, 23), 0.8)
            .otherwise(0.7)
        )
    base = by_hour
    if shift is not None:
        table = F.create_map(*[F.lit(x) for pair in SHIFT_RISK.items() for x in pair])
        base = F.coalesce(F.try_element_at(table, shift), by_hour)
    if weekday is None:
        return clamp(base)
    return clamp(base + F.when(weekday.isin(4, 5, 6), 0.1).otherwise(0.0))


def composite_risk(components: dict[str, Column], weights: dict[str, float] = RISK_WEIGHTS) -> Column:
    terms = [components[name] * F.lit(weight) for name, weight in weights.items()]
    return clamp(reduce(lambda a, b: a + b, terms))


def risk_band(score: Column) -> Column:
    low, high = BAND_EDGES
    return (
        F.when((score >= 0) & (score <= low), BAND_NAMES[0])
        .when((score > low) & (score <= high), BAND_NAMES[1])
        .when((score > high) & (score <= 1), BAND_NAMES[2])
    )


def band(value: Column, high: float, middle: float, names: tuple[str, str, str]) -> Column:
    """Alert band of a rate by two thresholds."""
    return F.when(value >= high, names[0]).when(value >= middle, names[1]).otherwise(names[2])


# --- fixed values: wording of the recommendations -----------------------------
NOTE_CRITICAL = "Situação de alto risco - extrema cautela"
NOTE_HIGH = "Risco elevado - solicitar backup"
NOTE_MEDIUM = "Risco moderado - manter protocolo padrão"
NOTE_LOW = "Risco baixo - abordagem padrão"
NOTE_LETHAL = "ARMA LETAL PRESENTE - máxima cautela"
NOTE_BLADE = "Arma branca - manter distância"
NOTE_MANY = "Múltiplos suspeitos - necessário reforço"
NOTE_VIOLENT = "Crime violento - protocolo especial"
GEAR_VEST = "Colete balístico"
GEAR_SHIELD = "Escudo tático"
BLADE = "Faca"
# --- end of fixed values -------------------------------------------------------


def recommendation(
    score: Column, crime: Column | None = None, weapon: Column | None = None, suspects: Column | None = None
) -> Column:
    """Struct: priority level, protocol, backup flag, equipment list, notes list."""
    no = F.lit(False)
    lethal = F.coalesce(weapon.isin(LETHAL_WEAPONS), no) if weapon is not None else no
    blade = F.coalesce(weapon == BLADE, no) if weapon is not None else no
    many = F.coalesce(suspects >= 3, no) if suspects is not None else no
    violent = F.coalesce(crime.isin(PROTOCOL_CRIMES), no) if crime is not None else no

    def by_score(critical, high, medium, low):
        return F.when(score >= 0.8, critical).when(score >= 0.6, high).when(score >= 0.4, medium).otherwise(low)

    def chosen(*pairs):
        return F.array_compact(F.array(*[F.when(test, text) for test, text in pairs]))

    return F.struct(
        by_score("Critical", "High", "Medium", "Low").alias("priority_level"),
        F.when(violent, "High Risk")
        .otherwise(by_score("High Risk", "Enhanced", "Standard", "Standard"))
        .alias("response_protocol"),
        ((score >= 0.6) | lethal | many | violent).alias("backup_required"),
        chosen((lethal, GEAR_VEST), (lethal | blade, GEAR_SHIELD)).alias("special_equipment"),
        F.concat(
            F.array(by_score(NOTE_CRITICAL, NOTE_HIGH, NOTE_MEDIUM, NOTE_LOW)),
            chosen((lethal, NOTE_LETHAL), (blade, NOTE_BLADE), (many, NOTE_MANY), (violent, NOTE_VIOLENT)),
        ).alias("tactical_notes"),
    )
