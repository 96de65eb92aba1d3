"""Boundary cases on literal events (the reference has no tests of its own)."""
import pandas as pd
from pyspark.sql import functions as F

from sessionary.operators import events as P
from sessionary.operators import features as V
from sessionary.operators import ratings as R
from tests.conftest import events_df


def _sessions(spark, rows, gap=1800):
    out = P.sessionize(events_df(spark, rows), gap).orderBy("event_id").toPandas()
    return list(out["session_id"])


def test_gap_exactly_limit_stays_in_session(spark):
    rows = [(1, "2024-01-01 00:00:00", 7, "view", 1, -1),
            (2, "2024-01-01 00:30:00", 7, "view", 1, -1),          # gap 1800 s: same
            (3, "2024-01-01 01:00:00.001", 7, "view", 1, -1)]      # 1800.001 s: new
    assert _sessions(spark, rows) == [0, 0, 1]


def test_first_event_and_visitors_independent(spark):
    rows = [(1, "2024-01-01 00:00:00", 1, "view", 1, -1),
            (2, "2024-01-01 05:00:00", 2, "view", 1, -1),
            (3, "2024-01-01 06:00:00", 1, "view", 1, -1)]
    assert _sessions(spark, rows) == [0, 0, 1]


def test_ties_broken_by_event_id(spark):
    rows = [(2, "2024-01-01 00:00:00", 1, "view", 5, -1),
            (1, "2024-01-01 00:00:00", 1, "view", 5, -1)]
    enh = V.enhance_events(events_df(spark, rows)).orderBy("event_id").toPandas()
    # event 1 comes first, its next event (2) views the same item
    assert list(enh["repitem"]) == [1, 0]


def test_hour_range_and_weekday(spark):
    rows = [(1, "2024-01-07 05:59:59.999", 1, "view", 1, -1),   # a Sunday
            (2, "2024-01-07 06:00:00", 1, "view", 1, -1),
            (3, "2024-01-08 23:59:59", 1, "view", 1, -1)]       # Monday
    enh = V.enhance_events(events_df(spark, rows)).orderBy("event_id").toPandas()
    assert list(enh["hour_range"]) == [0, 1, 3]
    assert list(enh["week_day"]) == [0, 0, 1]


def test_delta_floors_seconds(spark):
    rows = [(1, "2024-01-01 00:00:12.999", 1, "view", 1, -1),
            (2, "2024-01-01 00:00:14.001", 1, "view", 2, -1)]
    enh = V.enhance_events(events_df(spark, rows)).orderBy("event_id").toPandas()
    assert enh["deltat_2equal_events"].iloc[1] == 2 / 60


def test_funnel_and_repeat_flags(spark):
    rows = [(1, "2024-01-01 00:00:00", 1, "view", 9, -1),
            (2, "2024-01-01 00:00:10", 1, "view", 9, -1),
            (3, "2024-01-01 00:00:20", 1, "addtocart", 4, -1),
            (4, "2024-01-01 00:00:30", 1, "transaction", 4, 77),
            (5, "2024-01-01 00:00:40", 1, "view", 5, -1),            # gap event
            (6, "2024-01-01 00:00:50", 1, "addtocart", 5, -1),
            (7, "2024-01-01 05:00:00", 1, "transaction", 5, 78)]     # next session
    enh = V.enhance_events(events_df(spark, rows)).orderBy("event_id").toPandas()
    assert list(enh["funnel_flag"]) == [0, 1, 0, 0, 1, 0, 0]
    assert list(enh["repitem"]) == [1, 0, 1, 0, 1, 1, 0]
    assert list(enh["repitem_fview"]) == [1, 0, 0, 0, 1, 0, 0]
    assert list(enh["repitem_bview"]) == [1, 0, 0, 0, 0, 0, 0]
    assert list(enh["session_id"]) == [0, 0, 0, 0, 0, 0, 1]


def test_views_in_one_minute_and_bouncers(spark):
    rows = [(1, "2024-01-01 00:00:01", 1, "view", 3, -1),
            (2, "2024-01-01 00:00:59", 1, "view", 3, -1),
            (3, "2024-01-01 00:01:00", 1, "view", 3, -1),
            (4, "2024-01-01 00:00:00", 2, "view", 1, -1),                 # bouncer
            (5, "2024-01-01 00:00:00", 3, "view", 1, -1),
            (6, "2024-01-01 00:00:05", 3, "view", 2, -1),
            (7, "2024-01-01 00:00:00", 4, "addtocart", 1, -1)]
    f = V.visitor_features(events_df(spark, rows)).orderBy("visitorid").toPandas()
    assert list(f["visitorid"]) == [1, 3, 4]
    assert f.set_index("visitorid").loc[1, "max_vpmin"] == 2
    g = V.visitor_features(events_df(spark, rows), drop_bouncers=False).toPandas()
    assert sorted(g["visitorid"]) == [1, 2, 3, 4]


def test_no_pair_gives_minus_one_and_session_stats(spark):
    rows = [(1, "2024-01-01 00:00:00", 1, "view", 3, -1),
            (2, "2024-01-01 00:00:30", 1, "addtocart", 3, -1),
            (3, "2024-01-01 03:00:00", 1, "view", 4, -1)]
    f = V.visitor_features(events_df(spark, rows)).toPandas().iloc[0]
    assert f["min_dltac"] == -1 and f["min_dltpr"] == -1
    assert f["min_dltvw"] == 180.0
    assert (f["min_vwpse"], f["avg_vwpse"], f["max_vwpse"]) == (1, 1.0, 1)
    assert (f["min_acpse"], f["avg_acpse"], f["max_acpse"]) == (0, 0.5, 1)


def test_weekday_compat_zeros(spark):
    rows = [(1, "2024-01-07 10:00:00", 1, "view", 1, -1),
            (2, "2024-01-07 10:00:01", 1, "view", 2, -1)]
    f = V.visitor_features(events_df(spark, rows), weekday_compat=True).toPandas()
    assert (f[V.WEEKDAY_COLUMNS].to_numpy() == 0).all()


def test_latest_rating_wins(spark):
    rows = [(1, "2024-01-01 00:00:00", 1, "view", 3, -1),
            (2, "2024-01-02 00:00:00", 1, "view", 3, -1),
            (3, "2024-01-01 12:00:00", 1, "addtocart", 3, -1),
            (4, "2024-01-01 00:00:00", 1, "view", 4, -1)]
    r = R.ratings(events_df(spark, rows)).orderBy("itemid").toPandas()
    assert list(r["rating"]) == [2, 1]
    assert str(r["timestamp"].iloc[0]) == "2024-01-01 12:00:00"


def test_hot_visitor_path_matches_plain(spark):
    from tests.conftest import SF_SMALL
    from sessionary.sources.tables import canonical_events
    ev = canonical_events(spark, SF_SMALL, "user")
    a = V.visitor_features(ev, parts=1).orderBy("visitorid").toPandas()
    b = V.visitor_features(ev, parts=90).orderBy("visitorid").toPandas()
    pd.testing.assert_frame_equal(a.round(9), b.round(9), check_dtype=False)


def test_event_codes_like_categories(spark):
    import pandas as pd
    ev = spark.createDataFrame(pd.DataFrame({"event": ["b", "a", "c", "a", None]}))
    out = P.event_codes(ev).toPandas()
    got = dict(zip(out["event"].fillna("<na>"), out["event_code"]))
    assert got == {"a": 0, "b": 1, "c": 2, "<na>": -1}


def test_one_row_group_and_constant_column(spark):
    import math
    from sessionary.operators.profile import normalize
    from sessionary.operators.stats import describe_by
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 5.0), ("b", 7.0, 5.0)],
                               "g string, x double, k double")
    d = describe_by(df, "g", "x").toPandas().set_index("g")
    assert d.loc["b", "count"] == 1 and math.isnan(d.loc["b", "std"])
    assert d.loc["a", "p50"] == 2.0
    z = normalize(df, "z_score", ["x", "k"]).toPandas()
    assert z["k"].isna().all() and not z["x"].isna().any()
    m = normalize(df, "min_max", ["x", "k"]).toPandas()
    assert m["k"].isna().all() and list(m["x"]) == [0.0, 2 / 6, 1.0]
