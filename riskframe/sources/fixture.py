"""Incident view over the test tables ``events``, ``customer`` and ``nation``.

The test data hold no incidents, so every query runs on this deterministic view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.lookup import lookup_join


def incident_view(spark: SparkSession, sf_dir: str, counted: bool = False) -> DataFrame:
    """``counted``: customers are broadcast only if their counted rows allow it, which takes jobs of its own."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")

    event_id = F.col("event_id")
    cents = F.rint(F.col("value") * 100).cast("long")
    mixed = (cents * 7919) % 10007 + (event_id * 31) % 101
    base = events.select("event_id", "ts", "user_id", "event_type", mixed.alias("h")).withColumn(
        "w", F.floor(F.col("h") / 10.0) % 10
    )
    customer, nation = customer.withColumnRenamed("c_custkey", "user_id"), nation.withColumnRenamed("n_nationkey", "c_nationkey")
    if counted:
        users = lookup_join(base, customer.hint("merge"), ["user_id"], "inner", spread_by="event_id")
    else:
        users = base.join(customer, "user_id")
    joined = users.join(nation, "c_nationkey")

    h, w = F.col("h"), F.col("w")

    def unless_every(step, value):
        return F.when(event_id % step != 0, value)

    def pick(key, values, other=None):
        expr = F
        for k, v in enumerate(values):
            expr = expr.when(key == k, v)
        return expr.otherwise(other) if other is not None else expr

    crime = pick(
        h % 10,
        ["Homicídio", "Latrocínio", "Sequestro", "Tráfico de Drogas", "Roubo", "Estupro",
         "Ameaça", "Violência Doméstica", "Furto"],
        "Estelionato",
    )
    weapon = (
        F.when(w < 5 - h % 10, "Arma de Fogo")
        .when((w == 9) & (h % 2 == 0), "Explosivos")
        .when(w.isin(1, 2, 6), "Faca")
        .when(w.isin(3, 7), "Objeto Contundente")
        .otherwise("Nenhum")
    )
    return joined.select(
        event_id.alias("id_ocorrencia"),
        unless_every(97, F.col("ts").cast("timestamp_ntz")).alias("data_ocorrencia"),
        unless_every(41, F.col("n_name")).alias("bairro"),
        crime.alias("tipo_crime"),
        unless_every(53, weapon).alias("arma_utilizada"),
        unless_every(31, h % 4).cast("double").alias("quantidade_suspeitos"),
        (w % 4).cast("double").alias("quantidade_vitimas"),
        unless_every(29, 16 + h % 50).cast("double").alias("idade_suspeito"),
        F.when(h % 5 < 3, "M").when(h % 5 == 3, "F").alias("sexo_suspeito"),
        unless_every(37, F.lit(-8.05) + (h % 100) / F.lit(1000.0)).alias("latitude"),
        (F.lit(-34.90) + ((w * 7) % 100) / F.lit(1000.0)).alias("longitude"),
        pick(F.col("user_id") % 3, ["Unidade A", "Unidade B"], "Unidade C").alias("orgao_responsavel"),
        pick(event_id % 4, ["Aberto", "Em andamento", "Concluído"]).alias("status_investigacao"),
        F.col("event_type").alias("descricao_modus_operandi"),
    )
