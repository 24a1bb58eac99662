"""Streaming ingest and histograms over the events table read as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablelens.plans.runtime import new_path
from tablelens.queries import query
from tablelens.queries.aggregation import histogram_sql
from tablelens.sources.tables import VersionedTable
from tablelens.streaming.jobs import file_stream, ingest, stream_histogram

EVENTS = {"event_id": "long", "ts": "date", "user_id": "long", "event_type": "keyword", "value": "double", "props": "keyword"}


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _(spark, d):
    stream = file_stream(spark, d, "events")
    table = VersionedTable(spark, f"events_{uuid.uuid4().hex}", EVENTS, "event_id", 8)
    table.create(spark.createDataFrame([], stream.schema))
    ingest(stream, table, new_path(spark, "progress"), "ts").awaitTermination()
    return table.read()


@query(
    "ingest_two_streams",
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
       UNION ALL SELECT -1 - event_id, ts, user_id, event_type, value, props FROM events""",
)
def _(spark, d):
    """Two streams with checkpoints of their own into one table."""
    table = VersionedTable(spark, f"events_{uuid.uuid4().hex}", EVENTS, "event_id", 8)
    table.create(spark.createDataFrame([], file_stream(spark, d, "events").schema))
    for key in (F.col("event_id"), -1 - F.col("event_id")):
        stream = file_stream(spark, d, "events").withColumn("event_id", key)
        ingest(stream, table, new_path(spark, "progress"), "ts").awaitTermination()
    return table.read()


def _histogram(interval: str, minutes: int, table: str = "events", field: str = "ts"):
    @query(f"stream_histogram_{interval}", histogram_sql(table, field, interval, minutes))
    def _(spark, d):
        path, view = new_path(spark, "histogram"), f"histogram_{uuid.uuid4().hex}"
        stream = file_stream(spark, d, table)
        stream_histogram(stream, field, interval, path, new_path(spark, "progress"), minutes, view=view).awaitTermination()
        return spark.table(view)


_histogram("day", 0)
_histogram("hour", 330)
_histogram("month", 0, "orders", "o_orderdate")
_histogram("quarter", 330, "orders", "o_orderdate")
_histogram("year", -90, "orders", "o_orderdate")


@query(
    "stream_histogram_closed_months",
    f"""WITH h AS ({histogram_sql("orders", "o_orderdate", "month", 0)})
      SELECT * FROM h WHERE bucket + INTERVAL 1 MONTH < (SELECT max(o_orderdate) - INTERVAL 2 DAY FROM orders)""",
)
def _(spark, d):
    """Each month once, when two days of the next one are in."""
    path = new_path(spark, "histogram")
    stream = file_stream(spark, d, "orders")
    stream_histogram(stream, "o_orderdate", "month", path, new_path(spark, "progress"), late="2 days", mode="append").awaitTermination()
    return spark.read.schema("key string, bucket timestamp_ntz, count long").parquet(path)
