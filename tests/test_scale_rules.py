"""Rules that keep work at scale in bounds: no hidden jobs, one sampling law, safe joins, text ids."""

import datetime as dt

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from riskframe.functions import lookup, running
from riskframe.functions.layout import spread
from riskframe.functions.numeric import hash_rank
from riskframe.operators import anomaly, evaluation, lloyd, prep, scoring
from riskframe.plans import catalog
from riskframe.plans.data import IncidentData
from riskframe.plans.registry import QUERIES
from riskframe.sources.fixture import incident_view
from riskframe.sources.incidents import read_csv, with_typed_id


def jobs_of(spark, name, build):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        build()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return list(sc.statusTracker().getJobIdsForGroup(name))


def test_spread_starts_no_job(spark):
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("id_ocorrencia")).count()
    joined = grouped.join(grouped.withColumnRenamed("count", "n"), "id_ocorrencia")
    assert jobs_of(spark, "spread", lambda: spread(joined)) == []
    assert spread(joined).count() == 7


@pytest.mark.parametrize("name", ["weapon_counts", "monthly_rate", "high_risk_flag", "temporal_patterns"])
def test_plain_queries_fit_no_median(spark, name):
    assert name in catalog.queries()
    fresh = IncidentData(spark, SF_DIR)
    started = jobs_of(spark, f"plain-{name}", lambda: QUERIES[name](fresh))
    assert not fresh.medians
    assert len(started) <= 3  # at most the footers of the three tables


@pytest.mark.parametrize("name,fitted", [("risk_category", 2), ("bairro_summary", 2), ("crime_risk_rank", 1), ("geo_center", 2)])
def test_queries_fit_the_medians_they_use(spark, name, fitted):
    fresh = IncidentData(spark, SF_DIR)
    QUERIES[name](fresh)
    assert len(fresh.medians) == fitted


@pytest.mark.parametrize("rows", [200, 5_000, 50_000])
def test_one_sampling_law_at_every_size(spark, rows):
    vecs = spark.range(rows).select(F.col("id").alias("id_ocorrencia"), F.array(F.col("id").cast("double")).alias("x"))
    got = anomaly.tree_samples(vecs, trees=20, sample=64, seed=9)
    by_tree = {r["tree"]: sorted(r["ids"]) for r in got.groupBy("tree").agg(F.collect_list(F.col("x")[0]).alias("ids")).collect()}
    assert len(by_tree) == 20
    for tree in (0, 7, 19):
        rank = hash_rank(F.concat_ws(":", F.lit(tree), "id_ocorrencia"), 9)
        want = [float(r[0]) for r in vecs.orderBy(rank, "id_ocorrencia").limit(64).select("id_ocorrencia").collect()]
        assert by_tree[tree] == sorted(want)


def test_joins_with_a_key_hot_on_either_side(spark, monkeypatch):
    monkeypatch.setattr(lookup, "SMALL_ROWS", 0)
    few = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    many = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 40).alias("k"), "id")
    want = many.join(few, "k").count()
    for left, right in ((many, few), (few, many)):
        joined = lookup.spread_join(left, right, ["k"], "inner")
        assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
        assert joined.select("k", "id", "v").distinct().count() == joined.count() == want
    outer = lookup.spread_join(few, many, ["k"], "left")
    assert outer.count() == few.join(many, "k", "left").count()


def test_bytes_bound_the_broadcast(spark):
    left = spark.range(100).select(F.col("id").alias("k"))
    wide = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("t"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(lookup.lookup_join(left, wide, ["k"]))
    assert "broadcast" not in plan(lookup.lookup_join(left, wide, ["k"], max_bytes=10_000))
    assert lookup.lookup_join(left, wide, ["k"], max_bytes=10_000).count() == 100


def test_running_totals_over_text(spark):
    rows = [(f"oc-{i}", i % 3, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "id string, g int, one long")
    got = running.running_totals(df, "id", ["one"], group=["g"], slices=8).collect()
    for g in range(3):
        ordered = sorted((r["id"], r["before_one"]) for r in got if r["g"] == g)
        assert [n for _, n in ordered] == list(range(len(ordered)))


CSV_HEAD = "id_ocorrencia,data_ocorrencia,bairro,tipo_crime,arma_utilizada,quantidade_suspeitos,idade_suspeito\n"


def csv_of(tmp_path, ids, times):
    lines = [f"{i},{t},B{k % 2},Roubo,{'Faca' if k % 3 else 'Arma de Fogo'},{k % 4},30" for k, (i, t) in enumerate(zip(ids, times))]
    path = tmp_path / "incidents.csv"
    path.write_text(CSV_HEAD + "\n".join(lines) + "\n")
    return str(path)


@pytest.mark.parametrize("pattern", ["%d/%m/%Y %H:%M", "%m/%d/%Y %H:%M:%S", "%d.%m.%Y", "%Y-%m-%d %H:%M:%S"])
@pytest.mark.parametrize("prefix", ["oc-", ""])
def test_from_csv_to_windows(spark, tmp_path, pattern, prefix):
    times = [dt.datetime(2024, 1 + k % 2, 1 + k % 28, 9) for k in range(60)]
    raw = read_csv(spark, csv_of(tmp_path, [f"{prefix}{k}" for k in range(60)], [t.strftime(pattern) for t in times]))
    assert dict(raw.dtypes)["id_ocorrencia"] == ("string" if prefix else "bigint")
    clean = prep.clean(raw, prep.fit_medians(raw), time_format=prep.fit_time_format(raw))
    read = {str(r[0]): r[1].date() for r in clean.select("id_ocorrencia", "data_ocorrencia").collect()}
    assert read == {f"{prefix}{k}": t.date() for k, t in enumerate(times)}
    pred = evaluation.predictions(scoring.with_risk(clean), "risk_score", keep=["bairro", "ano_mes"])
    found = evaluation.f1_at_k_by_window(pred, ["bairro", "ano_mes"]).collect()
    assert sorted(r["n"] for r in found) and sum(r["n"] for r in found) == 60


def test_ids_stay_text_if_one_is_no_number(spark):
    df = spark.createDataFrame([("9",), ("10",), (None,)], "id_ocorrencia string")
    assert with_typed_id(df).dtypes == [("id_ocorrencia", "bigint")]
    assert with_typed_id(df.union(spark.createDataFrame([("x1",)], "id string"))).dtypes == [("id_ocorrencia", "string")]


def test_the_best_of_several_starts(spark):
    vecs = spark.range(300).select(F.col("id").alias("id_ocorrencia"), F.array((F.col("id") % 10).cast("double")).alias("x"))
    cost = [lloyd.kmeans_fits(vecs, [4], 1, n, measures=True)[0][0].inertia for n in (1, 5)]
    assert cost[1] <= cost[0]


def test_repeated_passes_read_the_view_that_was_joined_once(spark, data):
    """No pass joins again, so the customers do not go through the driver once for each."""
    three = QUERIES["temporal_split"](data), data.flagged.select("quantidade_vitimas"), data.modelled
    for df in three:
        assert "c_nationkey" not in df._jdf.queryExecution().analyzed().toString()


def test_many_customers_are_not_broadcast(spark, data, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 40)  # of 150
    view = incident_view(spark, SF_DIR, counted=True)
    assert "strategy=merge" in view._jdf.queryExecution().optimizedPlan().toString()
    assert view.exceptAll(data.raw).count() == 0 and data.raw.exceptAll(view).count() == 0
