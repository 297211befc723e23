"""Frequent and risky combinations found by grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.numeric import np_round
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators.aggregates import HIGH, RATE, TOTAL, risk_by
from riskframe.schema import CRIME, MODUS, PLACE, SHIFT, WEAPON

# --- fixed values: names of the pattern kinds --------------------------------
PLACE_SHIFT = "Bairro + Turno de Alto Risco"
CRIME_WEAPON_PLACE = "Crime + Arma + Local Frequente"
TIME_CRIME = "Padrões Temporais de Alto Risco"
# --- end of fixed values ------------------------------------------------------


def place_shift(df: DataFrame, min_rows: int = 10, min_rate: float = 0.3, top: int = 10) -> DataFrame:
    rates = risk_by(df, [PLACE, SHIFT]).where((F.col(TOTAL) >= min_rows) & (F.col(RATE) >= min_rate))
    return (
        rates.orderBy(F.col(RATE).desc(), PLACE, SHIFT)
        .limit(top)
        .select(PLACE, SHIFT, TOTAL, HIGH, np_round(F.col(RATE), 6).alias(RATE))
    )


def crime_weapon_place(df: DataFrame, top: int = 15) -> DataFrame:
    keys = [CRIME, WEAPON, PLACE]
    return frequent_groups(df, keys, top)


def frequent_groups(df: DataFrame, keys: list[str], top: int) -> DataFrame:
    """Most frequent key combinations without nulls, ties in key order."""
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("qtd"))
    return counts.orderBy(F.col("qtd").desc(), *keys).limit(top)


def time_crime(df: DataFrame, min_rows: int = 5, min_rate: float = 0.5, top: int = 10) -> DataFrame:
    keys = ["dia_semana", "hora", CRIME]
    rates = risk_by(df, keys).where((F.col(TOTAL) >= min_rows) & (F.col(RATE) >= min_rate))
    return (
        rates.orderBy(F.col(RATE).desc(), *keys).limit(top).select(*keys, TOTAL, np_round(F.col(RATE), 6).alias(RATE))
    )


def pattern_summary(df: DataFrame) -> DataFrame:
    """Rows found per pattern kind, and how many kinds were found at all."""
    kinds = ((PLACE_SHIFT, place_shift(df)), (CRIME_WEAPON_PLACE, crime_weapon_place(df)), (TIME_CRIME, time_crime(df)))
    tagged = [frame.select(F.lit(name).alias("padrao")) for name, frame in kinds]
    rows = tagged[0].union(tagged[1]).union(tagged[2])
    counts = rows.groupBy("padrao").agg(F.count(F.lit(1)).alias("linhas"))
    # one row per kind, so this window sees at most three rows
    return counts.withColumn("total_padroes", F.count(F.lit(1)).over(Window.partitionBy())).orderBy("padrao")


def pattern_labels(df: DataFrame, top: int = 10) -> DataFrame:
    """Bar labels of the place/shift and crime/weapon patterns."""
    first = place_shift(df, top=top).select(
        F.lit(PLACE_SHIFT).alias("padrao"),
        F.concat_ws(" - ", PLACE, SHIFT).alias("rotulo"),
        F.col(RATE).alias("valor"),
    )
    second = frequent_groups(df, [CRIME, WEAPON, PLACE], top).select(
        F.lit(CRIME_WEAPON_PLACE).alias("padrao"),
        F.concat_ws(" + ", CRIME, WEAPON).alias("rotulo"),
        F.col("qtd").cast("double").alias("valor"),
    )
    return first.unionByName(second)


def top_danger_combos(df: DataFrame, score: str = "risk_score", level: float = 0.8, top: int = 12) -> DataFrame:
    """Most frequent (place, crime) and (crime, modus) among the highest-scored rows."""
    cut = exact_quantiles(df, [score], [level])[score][0]
    danger = df.where(F.col(score) >= F.lit(cut))
    parts = []
    for keys in ([PLACE, CRIME], [CRIME, MODUS]):
        parts.append(
            frequent_groups(danger, keys, top).select(
                F.lit("+".join(keys)).alias("combinacao"),
                F.col(keys[0]).alias("a"),
                F.col(keys[1]).alias("b"),
                "qtd",
            )
        )
    return parts[0].unionByName(parts[1])
