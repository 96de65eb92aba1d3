"""Table loading (S1) and the adapter from the given ``events`` table.

Two entry points produce the same *canonical* events frame

    event_id BIGINT, timestamp TIMESTAMP, visitorid BIGINT, event STRING,
    itemid INT, transactionid BIGINT (-1 = none)

* ``read_raw_events_csv``: the shop export (epoch-ms timestamps, nullable
  transaction ids), headered CSV with an explicit schema.
* ``canonical_events``: the parquet ``events`` table of the test data
  (``event_id, ts, user_id, event_type, value, props``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionary.functions.columns import fill_missing_id
from sessionary.functions.time import epoch_ms_to_timestamp
from sessionary.session import ensure_session_rules

# Event types of the test table and the shop event names they
# stand for.  Other types pass through under their own name.
EVENT_TYPE_MAP = {
    "view": "view",
    "click": "addtocart",
    "purchase": "transaction",
}

RAW_EVENTS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("visitorid", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("transactionid", T.DoubleType()),
])

# Schemas of the shop export's other tables.
CSV_SCHEMAS = {
    "item_properties": "timestamp BIGINT, itemid BIGINT, property STRING, value STRING",
    "category_tree": "categoryid BIGINT, parentid BIGINT",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one table (pruning/pushdown happen at the scan)."""
    ensure_session_rules(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load_tables(spark: SparkSession, paths: dict[str, str],
                register: bool = True) -> dict[str, DataFrame]:
    """One lazy DataFrame per named path; registered as temp views.

    ``.csv`` paths are read headered with a fixed schema (``CSV_SCHEMAS``; a
    table without one is read as strings), other paths as parquet.  No file is
    read before a query touches its table.
    """
    ensure_session_rules(spark)
    out = {}
    for name, path in paths.items():
        if name == "events" and path.endswith(".csv"):
            df = read_raw_events_csv(spark, path)
        elif path.endswith(".csv"):
            df = read_csv(spark, path, CSV_SCHEMAS.get(name))
        else:
            df = spark.read.parquet(path)
        if register:
            df.createOrReplaceTempView(name)
        out[name] = df
    return out


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Headered CSV with a given schema; without one every column is a string."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_raw_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Shop export -> canonical events (P1 epoch ms, P4 transaction fill).

    The export carries no event id; a deterministic tie-breaker is derived from
    the row content (two identical rows are interchangeable anyway).
    """
    ensure_session_rules(spark)
    raw = spark.read.schema(RAW_EVENTS_SCHEMA).option("header", True).csv(path)
    return prepare_raw(raw)


def prepare_raw(raw: DataFrame) -> DataFrame:
    """Raw shop rows (epoch-ms ``timestamp``) -> canonical events."""
    cols = raw.columns
    tie = (F.col("event_id") if "event_id" in cols
           else F.xxhash64("timestamp", "visitorid", "event", "itemid", "transactionid"))
    return raw.select(
        tie.cast("bigint").alias("event_id"),
        epoch_ms_to_timestamp("timestamp").alias("timestamp"),
        F.col("visitorid").cast("bigint").alias("visitorid"),
        F.col("event").cast("string").alias("event"),
        F.col("itemid").cast("int").alias("itemid"),
        fill_missing_id("transactionid").alias("transactionid"),
    )


def visitor_key(mapping: str = "user"):
    """Visitor id of the test table: per user, or per user and day."""
    if mapping == "user":
        return F.col("user_id").cast("bigint")
    if mapping == "user_day":
        return (F.col("user_id") * F.lit(100) + F.dayofmonth("ts")).cast("bigint")
    raise ValueError(f"unknown visitor mapping {mapping!r}; use 'user' or 'user_day'")


def item_id():
    """Item id from the JSON properties (``{"k": <item>}``), as INT."""
    return F.from_json("props", "k string")["k"].cast("int")


def _event_name():
    expr = F.col("event_type")
    for src, dst in EVENT_TYPE_MAP.items():
        expr = F.when(F.col("event_type") == F.lit(src), F.lit(dst)).otherwise(expr)
    return expr


def raw_events(spark: SparkSession, sf_dir: str, mapping: str = "user") -> DataFrame:
    """Test table -> raw shop rows (epoch-ms timestamp, nullable transaction)."""
    ev = read_table(spark, sf_dir, "events")
    return (
        ev.select(
            F.col("event_id"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
            visitor_key(mapping).alias("visitorid"),
            _event_name().alias("event"),
            item_id().alias("itemid"),
            F.when(F.col("event_type") == "purchase", F.col("event_id").cast("double"))
            .alias("transactionid"),
        )
    )


def canonical_events(spark: SparkSession, sf_dir: str, mapping: str = "user") -> DataFrame:
    """Test table -> canonical events, all of its rows.  The projection reaches the scan."""
    ev = read_table(spark, sf_dir, "events")
    return (
        ev.select(
            F.col("event_id"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            visitor_key(mapping).alias("visitorid"),
            _event_name().alias("event"),
            item_id().alias("itemid"),
            F.when(F.col("event_type") == "purchase", F.col("event_id"))
            .otherwise(F.lit(-1)).cast("bigint").alias("transactionid"),
        )
    )


def load_queries(spark: SparkSession, sql_paths: dict[str, str],
                 tables: dict[str, DataFrame] | None = None,
                 downcast: bool = False) -> dict[str, DataFrame]:
    """Run each named SQL file over the registered tables.

    ``tables`` are registered as temp views first; each result is registered
    under its own name too, so later files can use earlier results.  With
    ``downcast`` every integer column is narrowed (P5).
    """
    ensure_session_rules(spark)
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    out = {}
    for name, path in sql_paths.items():
        with open(path) as fh:
            text = fh.read()
        df = spark.sql(text)
        if downcast:
            from sessionary.operators.events import downcast as narrow
            df = narrow(df)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


SQL_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                       "plans", "sql")
