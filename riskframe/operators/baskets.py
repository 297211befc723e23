"""Frequent itemsets and rules of baskets: rows with an array of any number of items.

Itemsets come from FP-trees, which Spark grows in parallel over groups of items.  Rules are grown level by level: a
consequent can only reach the confidence if all of its parts do, so longer ones are joined from shorter ones and the
2**n splits of a long itemset are never listed.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.lookup import lookup_join
from riskframe.functions.numeric import np_round
from riskframe.session import checkpointed

ITEMSET_SCHEMA = "items array<string>, n long, support double"


def frequent_itemsets(df: DataFrame, items: str, min_support: float = 0.05) -> DataFrame:
    """(items, n, support): sets of distinct items that at least a share of the baskets holds, items in ascending order.

    Null items and repeats inside a basket do not count; a basket without items is no basket.
    """
    held = F.array_distinct(F.array_compact(F.col(items).cast("array<string>")))
    baskets = df.select(held.alias("items")).where(F.size("items") > 0)
    baskets = checkpointed(baskets)  # the items are counted first, then the trees grown
    total = baskets.count()
    if not total:
        return df.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
    found = FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets).freqItemsets
    support = F.col("freq") / F.lit(float(total))
    return found.select(F.array_sort("items").alias("items"), F.col("freq").alias("n"), support.alias("support")).where(
        F.col("support") >= min_support
    )


def association_rules(itemsets: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Rules of ``itemsets(items, support)``, which must hold all subsets of each set, with consequents of any size.

    antecedents, consequents, support, confidence and lift, both sides in ascending order; sorted by lift.
    """
    itemsets = checkpointed(itemsets.select(F.array_sort("items").alias("items"), "support"))
    sides = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("a_support"))

    def confident(candidates: DataFrame) -> DataFrame:
        split = candidates.withColumn("antecedents", F.array_except("items", "consequents"))
        found = lookup_join(split, sides, ["antecedents"], "inner")
        return checkpointed(found.where(F.col("support") / F.col("a_support") >= min_confidence))

    long = itemsets.where(F.size("items") >= 2)
    level = confident(long.withColumn("consequents", F.explode(F.transform("items", lambda x: F.array(x)))))
    rules, size = level, 1
    while not level.isEmpty():
        # two consequents of the same set that differ in their last item alone
        head = F.slice("consequents", 1, size - 1) if size > 1 else F.array().cast("array<string>")
        part = level.where(F.size("items") > size + 1).select("items", "support", head.alias("head"), F.element_at("consequents", -1).alias("last"))
        other = part.select("items", "head", F.col("last").alias("next"))
        joined = part.join(other, ["items", "head"]).where("last < next")
        level = confident(joined.select("items", "support", F.concat("head", F.array("last", "next")).alias("consequents")))
        rules, size = rules.unionByName(level), size + 1
    consequents = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("c_support"))
    confidence = F.col("support") / F.col("a_support")
    return lookup_join(rules, consequents, ["consequents"], "inner").select(
        "antecedents",
        "consequents",
        np_round(F.col("support"), 3).alias("support"),
        np_round(confidence, 2).alias("confidence"),
        np_round(confidence / F.col("c_support"), 2).alias("lift"),
    ).orderBy(
        F.col("lift").desc(), F.col("confidence").desc(), F.col("support").desc(),
        F.array_join("antecedents", ", "), F.array_join("consequents", ", "),
    )
