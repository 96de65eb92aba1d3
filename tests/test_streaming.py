"""Streaming session counts equal the batch ones for every finalised session."""
import os
import tempfile

from pyspark.sql import functions as F

from sessionary.operators import events as P
from sessionary.operators import features as V
from sessionary.sources.tables import canonical_events
from sessionary.streaming import canonical_event_stream, session_counts_stream
from tests.conftest import SF_SMALL


def test_stream_sessions_match_batch(spark):
    out = tempfile.mkdtemp(prefix="stream-test-")
    stream = session_counts_stream(canonical_event_stream(spark, SF_SMALL))
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", os.path.join(out, "ckpt"))
         .trigger(availableNow=True).start(os.path.join(out, "data")))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(out, "data"))
    ev = canonical_events(spark, SF_SMALL, "user")
    enh = V.enhance_events(ev)
    batch = (enh.groupBy("visitorid", "session_id")
             .agg(F.min("timestamp").alias("session_start"),
                  F.count_if(F.col("event") == "view").alias("num_views"),
                  F.count_if(F.col("event") == "addtocart").alias("num_acart"),
                  F.count_if(F.col("event") == "transaction").alias("num_purch")))
    cols = ["visitorid", "session_start", "num_views", "num_acart", "num_purch"]
    g = sorted(map(tuple, got.select(*cols).toPandas().values.tolist()))
    b = {tuple(r) for r in batch.select(*cols).toPandas().values.tolist()}
    assert len(g) > 0
    assert set(g) <= b                 # every emitted session is a batch session
    # every batch session that ended two hours before the last event is emitted
    last = ev.agg(F.max("timestamp")).first()[0]
    ends = (enh.groupBy("visitorid", "session_id")
            .agg(F.min("timestamp").alias("s"), F.max("timestamp").alias("e"))
            .where(F.col("e") < F.lit(last) - F.expr("INTERVAL 3 HOURS")).count())
    assert len(g) >= ends
