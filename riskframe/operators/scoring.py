"""Risk scores, alerts and recommendations for whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import risk
from riskframe.functions.lookup import lookup_join
from riskframe.functions.numeric import np_round
from riskframe.schema import (
    BASELINE_CRIMES,
    CRIME,
    ID,
    LABEL,
    PLACE,
    RISK_WEIGHTS,
    SHIFT,
    WEAPON,
)
from riskframe.session import checkpointed


def place_rates(history: DataFrame) -> DataFrame:
    """Share of high-risk incidents per place."""
    return history.where(F.col(PLACE).isNotNull()).groupBy(PLACE).agg(F.avg(LABEL).alias("place_rate"))


def with_risk(
    df: DataFrame,
    history: DataFrame | None = None,
    weights: dict[str, float] = RISK_WEIGHTS,
    round_counts: bool = False,
    rates: DataFrame | None = None,
) -> DataFrame:
    """Add the five components, ``risk_score`` and ``risk_category``.

    ``history`` supplies the place rates; by default the rows themselves do.
    """

    def column(name):
        return F.col(name) if name in df.columns else None

    if PLACE in df.columns:
        if rates is None:
            rates = checkpointed(place_rates(df if history is None else history))  # a row per place, read twice
        spread_by = ID if ID in df.columns else None
        joined = lookup_join(df, rates, [PLACE], "left", spread_by=spread_by)
        rate = F.col("place_rate")
    else:
        joined, rate = df, F.lit(None).cast("double")

    missing_text = F.lit(None).cast("string")
    missing_number = F.lit(None).cast("double")
    parts = {
        "weapon_risk": risk.weapon_risk(F.col(WEAPON) if WEAPON in df.columns else missing_text),
        "crime_risk": risk.crime_risk(F.col(CRIME) if CRIME in df.columns else missing_text),
        "suspect_risk": risk.suspect_risk(
            F.col("quantidade_suspeitos") if "quantidade_suspeitos" in df.columns else missing_number,
            column("idade_suspeito"),
            round_counts,
        ),
        "location_risk": risk.location_risk(rate),
        "temporal_risk": risk.temporal_risk(column("hora"), column("dia_semana_idx"), column(SHIFT)),
    }
    scored = joined.withColumns(parts).drop("place_rate")
    score = risk.composite_risk({name: F.col(name) for name in parts}, weights)
    return scored.withColumn("risk_score", score).withColumn("risk_category", risk.risk_band(F.col("risk_score")))


def with_recommendation(df: DataFrame) -> DataFrame:
    """Add the fields of the tactical recommendation."""
    advice = risk.recommendation(
        F.col("risk_score"), F.col(CRIME), F.col(WEAPON), F.col("quantidade_suspeitos")
    )
    return df.withColumn("_advice", advice).select(*df.columns, "_advice.*")


def high_risk_alerts(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Incidents at or above the threshold, highest first, with their first note."""
    note = risk.recommendation(F.col("risk_score"), F.col(CRIME), F.col(WEAPON)).getField("tactical_notes")
    return (
        df.where(F.col("risk_score") >= threshold)
        .withColumn("tactical_recommendation", note[0])
        .orderBy(F.col("risk_score").desc(), F.col(ID))
    )


def rule_baseline(df: DataFrame) -> DataFrame:
    """Hand-written yes/no rule: violent crime, several suspects, or any day but Thursday."""
    rule = (
        F.coalesce(F.col(CRIME).isin(BASELINE_CRIMES), F.lit(False))
        | F.coalesce(F.col("quantidade_suspeitos") >= 2, F.lit(False))
        | F.coalesce(F.col("dia_semana_idx") != 3, F.lit(False))
    )
    return df.withColumn("rule_prediction", rule.cast("int"))


def score_summary(df: DataFrame) -> DataFrame:
    """Mean score and shares of high (>= 0.7) and low (<= 0.3) scores, in percent."""
    score = F.col("risk_score")
    return df.agg(
        np_round(F.avg(score), 6).alias("avg_risk_score"),
        np_round(F.avg((score >= 0.7).cast("double")) * 100, 6).alias("high_risk_percentage"),
        np_round(F.avg((score <= 0.3).cast("double")) * 100, 6).alias("low_risk_percentage"),
    )
