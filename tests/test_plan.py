"""Plan shape of the flagship query."""
from sessionary.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _scan_plans(spark, monkeypatch):
    """Plans of the sorted pass and of the rest of the flagship query."""
    from sessionary.operators import sequence
    first, write = [], sequence.materialize

    def seen(df):
        first.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)
    monkeypatch.setattr(sequence, "materialize", seen)
    rest = _plan(spark, "visitor_features")
    assert len(first) == 1
    return first[0], rest


def test_visitor_features_exchanges(spark, monkeypatch):
    """All events are shuffled once, by range; what follows is combined map-side."""
    first, rest = _scan_plans(spark, monkeypatch)
    assert first.count("Exchange") == 1 and "Exchange rangepartitioning(visitorid" in first
    assert rest.count("Exchange hashpartitioning(visitorid") <= 2
    assert rest.count("Exchange") - rest.count("BroadcastExchange") <= 2
    assert rest.count("BroadcastExchange") == 1  # one row per partition
    for plan in (first, rest):
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Window" not in plan


def test_scan_prunes_and_pushes(spark, monkeypatch):
    plan = _scan_plans(spark, monkeypatch)[0]
    assert "PushedFilters: [IsNotNull(user_id)]" in plan  # all event types are read
    assert "value" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_no_cartesian_or_nested_loop_joins(spark):
    """No registered query pairs rows without an equi-key."""
    from sessionary.plans.sql_registry import ORACLE
    names = set(ORACLE) | {"iforest_score", "shap_instance", "dbscan",
                           "feature_stats_by_anomaly", "kde_anomaly", "sample_stratified"}
    bad = {}
    for name, fn in QUERIES.items():
        if name not in names:
            continue
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        hits = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad
