"""Input of the run-log streams: events in order of time, in two parts."""

import datetime as dt

from pyspark.sql import functions as F

from spark_elt.plans import fixtures as fx
from spark_elt.plans import q_streaming

EVENTS = (
    "run_id long, node_path array<string>, event string, ts timestamp_ntz, is_pipeline boolean, succeeded boolean, message string, "
    "format string, is_error boolean, seq long"
)


def test_run_events_are_made_once(spark, monkeypatch):
    rows = [(i, ["a", "b"], "NodeStarted", dt.datetime(2024, 1, 1 + i), None, None, None, None, None, i) for i in range(30)]
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    events = spark.createDataFrame(rows, EVENTS).withColumn("seq", F.udf(seen, "long").asNondeterministic()("seq"))
    monkeypatch.setattr(fx, "run_events", lambda spark, sf_dir: events)
    schemas = []
    q_streaming._arrivals(spark, "", lambda ev: schemas.append(ev.columns), "NodeStarted")
    assert made.value == len(rows)
    assert len(schemas) == 2 and schemas[0] == [c for c in events.columns if c != "node_path"] + ["path_key"]
