"""The toxicity network learns from every labelled document and window, not from its first sample alone."""

import pandas as pd
from pyspark.sql import functions as F
from riskframe.llm import toxicity_gru


def labelled(spark, n=1200):
    """Every third text is toxic.  Rows whose hash comes first, which the sample takes, know only one of the two kinds of toxic words."""
    plain = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit("word"), F.xxhash64("doc_id", i) % 150)))
    late = F.repeat(F.concat(plain, F.lit(" ")), 25)
    first = F.row_number().over(toxicity_gru_order())
    bad = F.when(first <= 200, "blorgish blorgish blorgish").otherwise("zumpadook zumpadook zumpadook")
    rows = spark.range(n).withColumnRenamed("id", "doc_id").withColumn("toxic", (F.col("doc_id") % 3 == 0).cast("int"))
    rows = rows.withColumn("bad", bad).withColumn("long", F.col("doc_id") % 30 == 0)
    text = F.when(F.col("toxic") == 0, plain).when(F.col("long"), F.concat_ws(" ", late, "bad", plain)).otherwise(F.concat_ws(" ", plain, "bad", plain))
    return rows.withColumn("text", text)


def toxicity_gru_order():
    from pyspark.sql.window import Window

    return Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"))


def test_words_outside_the_sample_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(toxicity_gru.training_rows, "__defaults__", (60, 120))
    rows = labelled(spark).cache()
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "toxic")
    found = toxicity_gru.toxicity_scores(docs, labels).join(rows.select("doc_id", "toxic", "bad"), "doc_id").toPandas()
    new = found[(found["toxic"] == 1) & found["bad"].str.contains("zump")]
    assert len(new) > 100 and (new["predicted"] == 1).mean() > 0.9
    assert (found[found["toxic"] == 0]["predicted"] == 0).mean() > 0.95
    kept = toxicity_gru.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == (found["score"] < toxicity_gru.THRESHOLD).sum()


def test_every_window_of_a_long_text_is_weighed():
    texts = [" ".join(f"word{i % 97}" for i in range(3000)), "", "word1 word2"]
    scorer = toxicity_gru.Scorer(toxicity_gru.Network(1))
    windows, toxic = toxicity_gru.unsure_windows(scorer, texts, pd.Series([0, 0, 1]).to_numpy())
    assert len(windows) == len(toxicity_gru._windows(3000)) + 2 and toxic == [0] * (len(windows) - 1) + [1]


def test_summed_gradients_do_not_depend_on_the_parts(spark):
    rows = [(f"alpha beta{i % 7} gamma", i % 2) for i in range(40)]
    network = toxicity_gru.Network(5)
    whole = toxicity_gru.GradientSum(network, (0.1, 0.2))
    whole.add([r[0] for r in rows], pd.Series([r[1] for r in rows]).to_numpy())
    want, loss = toxicity_gru.gradients_of(network, dict(whole.pieces()))
    frame = spark.createDataFrame(rows, "window string, toxic int").repartition(5)
    got, other = toxicity_gru.summed_gradients(frame, network, (0.1, 0.2))
    assert abs(loss - other) < 1e-4 * abs(loss)
    assert abs(want["o"] - got["o"]).max() < 1e-4 and (want["word"][0] == got["word"][0]).all()


def test_a_task_without_unsure_windows(spark):
    network = toxicity_gru.Network(5)
    network.p["c"] -= 50
    rows = spark.createDataFrame([("alpha beta", 0), ("gamma", 0), ("delta", 1)], "text string, toxic int").repartition(3, "text")
    found = toxicity_gru.unsure(rows, network).collect()
    assert [tuple(r) for r in found] == [("delta", 1)]
    assert toxicity_gru.unsure(rows.where("toxic = 0"), network).count() == 0
