"""The isolation forest reads its input once."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType
from riskframe.operators import anomaly


def test_vectors_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def vector(i):
        made.add(1)
        return [float(i % 7), float(i % 11), float(i * i % 13)]

    rows = spark.range(400).select(F.col("id").alias("id_ocorrencia"), F.udf(vector, ArrayType(DoubleType()))("id").alias("x"))
    flagged = anomaly.detect_anomalies(rows, trees=10, sample=32)
    assert flagged.count() == 400 and made.value == 400
    plain = anomaly.anomaly_scores(rows, trees=10, sample=32).select("id_ocorrencia", F.col("anomaly_score").alias("again"))
    assert flagged.join(plain, "id_ocorrencia").where("abs(anomaly_score - again) < 1e-12").count() == 400
