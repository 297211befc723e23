"""Frequent itemsets and association rules of high-risk incidents.

A transaction has at most one item from each of five columns, so the exact support
of every itemset is a cell of the cube over those columns.  Rows are first counted
per distinct combination; only those counts are expanded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.numeric import np_round
from riskframe.schema import CRIME, LABEL, PLACE, SHIFT, WEAPON
from riskframe.session import checkpointed

# fixed values: item prefixes, in item order
ITEM_PREFIXES = {PLACE: "Bairro_", CRIME: "Crime_", WEAPON: "Arma_", SHIFT: "Turno_", "dia_semana": "Dia_"}
#: High-risk rows, and among them rows with an item, below which there are no rules.
MIN_HIGH_RISK, MIN_TRANSACTIONS = 10, 5
CRITICAL_LIFT = 2.0

ITEMSET_SCHEMA = "items array<string>, n long, support double"


def item(column: str) -> Column:
    return F.concat(F.lit(ITEM_PREFIXES[column]), F.col(column).cast("string"))


def _high_risk(df: DataFrame) -> DataFrame:
    return df.where(F.col(LABEL) == 1) if LABEL in df.columns else df


def transactions(df: DataFrame) -> DataFrame:
    """High-risk rows that have at least one item, with their item list."""
    columns = [c for c in ITEM_PREFIXES if c in df.columns]
    items = F.array_compact(F.array(*[item(c) for c in columns]))
    return _high_risk(df).withColumn("items", items).where(F.size("items") > 0)


def frequent_itemsets(df: DataFrame, min_support: float = 0.05) -> DataFrame:
    """All itemsets of at least ``min_support``; at most 31 / min_support rows.

    None if there are fewer than ``MIN_HIGH_RISK`` high-risk rows, or fewer than ``MIN_TRANSACTIONS`` with an item.
    """
    columns = [c for c in ITEM_PREFIXES if c in df.columns]
    if not columns:
        return df.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
    combos = checkpointed(_high_risk(df).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")))  # the only pass over the rows
    some = F.coalesce(*columns).isNotNull()
    counts = combos.agg(F.sum("n").alias("rows"), F.sum(F.when(some, F.col("n"))).alias("baskets")).first()
    total = counts["baskets"] or 0
    if (counts["rows"] or 0) < MIN_HIGH_RISK or total < MIN_TRANSACTIONS:
        return df.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
    cells = combos.cube(*columns).agg(F.sum("n").alias("n"), *[F.grouping(c).alias(f"_g_{c}") for c in columns])
    used = [(F.col(f"_g_{c}") == 0, c) for c in columns]
    no_null_item = reduce(lambda a, b: a & b, [~u | F.col(c).isNotNull() for u, c in used])
    some_item = reduce(lambda a, b: a | b, [u for u, _ in used])
    support = F.col("n") / F.lit(float(total))
    frequent = cells.where(no_null_item & some_item & (support >= min_support))
    items = F.array_compact(F.array(*[F.when(u, item(c)) for u, c in used]))
    return frequent.select(items.alias("items"), "n", support.alias("support"))


def association_rules(df: DataFrame, min_support: float = 0.05, min_confidence: float = 0.5) -> DataFrame:
    return rules_from_itemsets(frequent_itemsets(df, min_support), min_confidence)


def rules_from_itemsets(itemsets: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Every split of every itemset into two sides, with confidence and lift.

    The itemset table is bounded by 31 / min_support rows and each itemset has at
    most 30 splits, so the two lookups of side supports are small joins.
    """
    itemsets = checkpointed(itemsets)
    size = F.size("items")
    splits = itemsets.where(size >= 2).select(
        "items", "support", F.explode(F.sequence(F.lit(1), (F.pow(F.lit(2), size) - 2).cast("int"))).alias("mask"),
    )

    splits = splits.withColumns(
        {
            "antecedents": F.expr("filter(items, (x, i) -> getbit(mask, i) = 1)"),
            "consequents": F.expr("filter(items, (x, i) -> getbit(mask, i) = 0)"),
        }
    )
    left = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("a_support"))
    right = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("c_support"))
    confidence = F.col("support") / F.col("a_support")
    rules = splits.join(left, "antecedents").join(right, "consequents").where(confidence >= min_confidence)
    return rules.select(
        "antecedents",
        "consequents",
        np_round(F.col("support"), 3).alias("support"),
        np_round(confidence, 2).alias("confidence"),
        np_round(confidence / F.col("c_support"), 2).alias("lift"),
    ).orderBy(
        F.col("lift").desc(), F.col("confidence").desc(), F.col("support").desc(),
        F.array_join("antecedents", ", "), F.array_join("consequents", ", "),
    )


def readable(items: Column) -> Column:
    """Items as one line, underscores shown as blanks."""
    return F.translate(F.array_join(items, ", "), "_", " ")


def top_rules(rules: DataFrame, top: int = 10) -> DataFrame:
    left, right = readable(F.col("antecedents")), readable(F.col("consequents"))
    return (
        rules.withColumn("regra", F.concat(left, F.lit(" → "), right))
        .orderBy(F.col("lift").desc(), F.col("confidence").desc(), F.col("support").desc(), "regra")
        .limit(top)
        .select(
            "regra",
            "support",
            "confidence",
            "lift",
            (F.col("lift") > CRITICAL_LIFT).cast("int").alias("critica"),
        )
    )
