"""Map points: every high-risk incident and a fixed-size sample of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.numeric import md5_rank, np_round
from riskframe.functions.sampling import smallest
from riskframe.schema import CRIME, ID, LABEL, PLACE, WEAPON


def located(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def geo_points(df: DataFrame, low_risk: int = 1000, seed: int = 42) -> DataFrame:
    """The sample is the ``low_risk`` smallest seeded hashes, the same on every run."""
    points = located(df)
    high = points.where(F.col(LABEL) == 1)
    rank = md5_rank(F.col(ID), seed)
    low = smallest(
        points.where(F.col(LABEL) == 0), rank, low_risk, lambda share: rank < F.lit(f"{int(share * 16**8):08x}")
    )

    def text(name):
        return F.coalesce(F.col(name), F.lit("N/A")) if name in df.columns else F.lit("N/A")

    hover = F.concat(
        F.lit("Bairro: "), text(PLACE), F.lit("<br>Crime: "), text(CRIME), F.lit("<br>Arma: "), text(WEAPON)
    )
    label = F.when(F.col(LABEL) == 1, hover).otherwise(text(PLACE))
    return high.unionByName(low).select(ID, "latitude", "longitude", LABEL, label.alias("texto"))


def geo_center(df: DataFrame) -> DataFrame:
    return located(df).agg(
        np_round(F.avg("latitude"), 6).alias("latitude"), np_round(F.avg("longitude"), 6).alias("longitude")
    )
