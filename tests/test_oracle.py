"""Every registered query with a SQL twin must agree with DuckDB."""

import pytest
from conftest import SF_DIR
from oracle_check import compare, duck
from riskframe.plans import catalog

ORACLES = catalog.oracle_sql()
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_results_do_not_depend_on_partitioning(spark, data):
    """Same rows, other partition counts, same results."""
    from riskframe.operators import evaluation as ev

    def run(parts):
        pred = data.pred.repartition(parts)
        return [
            sorted(map(tuple, ev.f1_at_k_by_window(pred, ["bairro", "ano_mes"]).collect())),
            sorted(map(tuple, ev.performance_curve(pred).collect())),
            ev.roc_auc(pred).first()[0],
        ]

    assert run(2) == run(13)


ZONED = ["filter_date_range", "last_24h", "fixed_date_split", "temporal_split", "time_parts", "daily_evolution", "detect_time_column"]


@pytest.mark.parametrize("name", ZONED)
def test_results_do_not_depend_on_the_session_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
