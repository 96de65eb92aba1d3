import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.chdir(ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sessionary.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ["events", "embeddings", "labels", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def events_df(spark, rows):
    """Canonical events from literal tuples
    (event_id, 'YYYY-mm-dd HH:MM:SS.ffffff', visitorid, event, itemid, tx)."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(
        rows, "event_id long, ts string, visitorid long, event string, itemid int, "
              "transactionid long")
    return df.select("event_id", F.to_timestamp("ts").alias("timestamp"), "visitorid",
                     "event", "itemid", "transactionid")
